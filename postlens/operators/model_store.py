"""Versioned store of fitted models on shared storage.

``root/<name>/versions/<id>/`` holds one package: every part (a Spark ML
model, a forest or a table) in a folder of its own. ``root/<name>/commits`` is
a log with one small row a saved version: its number and id, the kind of each
part, the features, the scores, and the digest of the data it was fitted on.
A package is written first and its row is appended last, by Spark's own
committer, so a reader sees a version whole or not at all, and an
interrupted save leaves the version before it current. Versions are never
changed; the current one is the row with the largest number.

``load_or_fit`` gives the current version if it was fitted on the same data,
and fits and saves one otherwise. ``digest`` is that identity: the row count
and the sum of all rows' hashes, which does not depend on their order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from postlens.operators.deep_forest import DeepForest

COMMITS = ("seq long, version string, fingerprint string, parts map<string,string>, features array<string>, "
           "scores map<string,double>, parameters map<string,double>, saved_at timestamp")


@dataclass
class Package:
    """Parts by name, the features they read, scores and number parameters."""

    parts: dict[str, object]
    features: list[str] = field(default_factory=list)
    scores: dict[str, float] = field(default_factory=dict)
    parameters: dict[str, float] = field(default_factory=dict)
    #: What the fit computed of every row it was given, for the scores of these rows; not saved.
    views: DataFrame | None = None


def digest(*frames: DataFrame) -> str:
    """Identity of the frames' rows, whatever their order and partitioning."""
    out = []
    for df in frames:
        r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)")).alias("h")).first()
        out.append(f"{','.join(df.columns)}:{r['n']}:{r['h']}")
    return "|".join(out)


def _write(part: object, path: str) -> str:
    if isinstance(part, DeepForest):
        part.save(path)
        return "forest"
    if isinstance(part, DataFrame):
        part.write.parquet(path)
        return "table"
    part.write().save(path)
    return "pipeline"


def _read(spark: SparkSession, kind: str, path: str) -> object:
    if kind == "forest":
        return DeepForest.load(spark, path)
    return spark.read.parquet(path) if kind == "table" else PipelineModel.load(path)


class ModelStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def commits(self, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(COMMITS).parquet(f"{self.root}/{name}/commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], COMMITS)

    def current(self, name: str) -> Row | None:
        """The commit of the current version."""
        return self.commits(name).orderBy(F.desc("seq"), F.desc("version")).first()

    def save(self, name: str, package: Package, fingerprint: str = "") -> str:
        """Write a package as a new version, then make it current."""
        before, version = self.current(name), uuid.uuid4().hex
        base = f"{self.root}/{name}/versions/{version}"
        kinds = {part: _write(value, f"{base}/{part}") for part, value in package.parts.items()}
        row = [((before["seq"] if before else 0) + 1, version, fingerprint, kinds, list(package.features),
                {k: float(v) for k, v in package.scores.items() if v is not None}, {k: float(v) for k, v in package.parameters.items()})]
        schema = COMMITS.rsplit(",", 1)[0]
        self.spark.createDataFrame(row, schema).withColumn("saved_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{self.root}/{name}/commits")
        return version

    def load(self, name: str, version: str | None = None) -> Package:
        """A version's package, the current one by default."""
        commit = self.current(name) if version is None else self.commits(name).where(F.col("version") == version).first()
        if commit is None:
            raise LookupError(f"no saved version of {name}")
        base = f"{self.root}/{name}/versions/{commit['version']}"
        parts = {part: _read(self.spark, kind, f"{base}/{part}") for part, kind in commit["parts"].items()}
        return Package(parts, list(commit["features"]), dict(commit["scores"]), dict(commit["parameters"]))

    def load_or_fit(self, name: str, fingerprint: str, fit: Callable[[], Package]) -> Package:
        """The current version if it was fitted on data of this identity; else
        ``fit`` is called and its package saved, and then loaded, so that a
        first and a later call score with the same files. The ``views`` of a
        package fitted now go on with it."""
        now = self.current(name)
        if now is not None and now["fingerprint"] == fingerprint:
            return self.load(name)
        fitted = fit()
        package = self.load(name, self.save(name, fitted, fingerprint))
        package.views = fitted.views
        return package
