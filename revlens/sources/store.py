"""Named results with versions.

A result is written to a folder of its own; then one small manifest row names
it.  A version exists once its manifest is committed, so a save that fails at
any point leaves the earlier versions as they were, and readers never see half
a result.  One writer per name at a time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.sources.sinks import small

_MANIFEST = "version long, path string, kind string"


class ResultStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _manifests(self, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(_MANIFEST).json(f"{self.root}/{name}/manifest/*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _MANIFEST)

    def versions(self, name: str) -> list[int]:
        return sorted(r["version"] for r in self._manifests(name).select("version").collect())

    def save(self, df: DataFrame, name: str) -> int:
        """Save a small result as the next version."""
        version = max(self.versions(name), default=0) + 1
        path = f"data/{version}-{uuid.uuid4().hex}"
        small(df).coalesce(1).write.json(f"{self.root}/{name}/{path}")
        kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        row = self.spark.createDataFrame([(version, path, kind)], _MANIFEST)
        row.coalesce(1).write.mode("error").json(f"{self.root}/{name}/manifest/{version}")
        return version

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A version of a result, by default the latest."""
        rows = self._manifests(name)
        found = rows.where(F.col("version") == version).first() if version else rows.orderBy(F.desc("version")).first()
        if not found:
            raise KeyError(f"no version {version or ''} of {name}")
        return self.spark.read.schema(found["kind"]).json(f"{self.root}/{name}/{found['path']}")
