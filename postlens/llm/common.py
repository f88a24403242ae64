"""Helpers shared by the training-data operators.

Conventions of every operator here: a null text counts as the empty text;
a null ``doc_id`` is kept and returned; repeated rows each get a result row
(operators that need one row per id say so); extra input columns are
ignored or, where an operator filters rows, passed through unchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.session import scratch_dir

#: ASCII white space of the `[^\x20\x09-\x0D]+` words; ``bytes.split()``
#: separates on exactly these.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
#: Everything that is not a word character of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
ALNUM_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _alnum_table() -> bytes:
    out = bytearray(range(256))
    for b in range(128):
        c = bytes([b]).lower()[0]
        out[b] = c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    return bytes(out)


#: Lower-cases A-Z and blanks every separator, so that ``split()`` gives the
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` words of a UTF-8 text.
ALNUM_TABLE = _alnum_table()


def alnum_words(text: str | None) -> list[bytes]:
    """Words of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return (text or "").encode().translate(ALNUM_TABLE).split()


def space_words(text: str | None) -> list[bytes]:
    """White-space separated words, A-Z lower-cased."""
    return (text or "").encode().lower().split()


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


#: Whether an execution's shuffle files are removed when it ends.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: later jobs start from the files, also after executors are lost, so
    the write's shuffle files go at its end and not with a later collection of
    garbage in the driver."""
    spark = df.sparkSession
    path, given = scratch_dir(spark, name), spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if given is None:
            spark.conf.unset(FILE_CLEANUP)
        else:
            spark.conf.set(FILE_CLEANUP, given)
    return spark.read.schema(df.schema).parquet(path)


def fold(key: Column, folds: int = 5) -> Column:
    """crc32 of the key's text, modulo ``folds`` (0 for a null key)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(0))


def map_texts(df: DataFrame, schema: str, rows: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]]) -> DataFrame:
    """``mapInArrow`` over the frame's partitions."""
    return df.mapInArrow(rows, schema)


def pieces(batch: pa.RecordBatch, column: str = "text", most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most about ``most_bytes`` of text each (one
    row at least), so that working memory follows the longest text only."""
    at, n, col = 0, batch.num_rows, batch.column(batch.schema.get_field_index(column))
    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    while at < n:
        end, total = at, 0
        while end < n and (end == at or total + sizes[end] <= most_bytes):
            total += int(sizes[end])
            end += 1
        yield batch.slice(at, end - at)
        at = end


#: Slots of an ``IdFilter`` for each id, and at most (one bit each, so 8 MB).
FILTER_SLOTS, MOST_SLOTS = 16, 1 << 26
_BLOCK = 1 << 15


class IdFilter:
    """One bit a slot of hashed ids, broadcast to the tasks: rows whose id is
    surely not among ``ids`` are told apart before a shuffle. Its size is
    bounded; with very many ids more rows pass, none is missed."""

    def __init__(self, ids: DataFrame, column: str):
        spark = ids.sparkSession
        n = ids.count()
        self.slots = min(MOST_SLOTS, max(_BLOCK, 1 << (FILTER_SLOTS * max(n, 1) - 1).bit_length()))
        slot = ids.select(self.slot(F.col(column)).alias("slot")).distinct()
        blocks = (slot.groupBy(F.shiftright("slot", 15).alias("block")).agg(F.collect_list(F.col("slot") % _BLOCK).alias("at"))
                  .mapInArrow(_packed, "block long, bits binary").collect())  # slots / 8 bytes at most
        bits = np.zeros(self.slots // 8, np.uint8)
        for r in blocks:
            bits[r["block"] * _BLOCK // 8:(r["block"] + 1) * _BLOCK // 8] = np.frombuffer(r["bits"], np.uint8)
        self.bits = spark.sparkContext.broadcast(bits)

    def slot(self, column: Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.slots).cast("long"))

    def rows(self, df: DataFrame, column: str, among: bool = True) -> DataFrame:
        """Rows whose id may be among the ids, or surely is not."""
        bits, names = self.bits, df.columns

        def kept(batches):
            for b in batches:
                slot = b.column(len(names)).to_numpy()
                hit = (bits.value[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == int(among)
                yield b.filter(pa.array(hit)).select(names)
                pa.default_memory_pool().release_unused()

        # the slot's name can't clash: it is one longer than the longest column's
        name = "_" * (1 + max(map(len, names)))
        return df.withColumn(name, self.slot(F.col(column))).mapInArrow(kept, df.schema)


def _packed(batches):
    for b in batches:
        out = []
        for at in b.column(1).to_pylist():
            bits = np.zeros(_BLOCK, np.uint8)
            bits[at] = 1
            out.append(np.packbits(bits).tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["block", "bits"])
