"""Column expressions over words and shingles (Spark built-ins only)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens.llm.common import ALNUM_GAP, SPACE_CLASS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used
    (the optimiser would otherwise repeat it inside lambdas)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is; null gives the empty text."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def _split(text: Column, gap: str) -> Column:
    return F.filter(F.split(ascii_lower(text), gap), lambda w: w != "")


def alnum_words(text: Column) -> Column:
    return _split(text, ALNUM_GAP)


def space_words(text: Column) -> Column:
    return _split(text, SPACE_CLASS)


def indices(n: Column) -> Column:
    """0 .. n-1, empty for n below 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def gram_hashes(hashes: Column, k: int) -> Column:
    """Hash of every run of k word hashes; ``hashes`` must be bound by
    ``let`` or a column."""
    return F.transform(indices(F.size(hashes) - (k - 1)), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]))
