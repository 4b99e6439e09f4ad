"""A keyed table as immutable files with a versioned list of them: a merge rewrites the files that hold its keys, and no others.

Rows are written in ranges of the key, so that the keys of a merge touch few files where they are near each other. Which files
they touch is found by a scan of the key column alone. Each change lists the files of the next version; those of the versions
before stay, and can be read. What a failed writer has left is in no list. Only names of files pass through the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.names import col, free
from corpusloom.operators.records import upsert
from corpusloom.sources.lines import Versions

_LIST = T.StructType().add("path", "string")


class KeyedFiles:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, position: str):
        self.spark, self.root, self.schema, self.key, self.position = spark, root.rstrip("/"), schema, key, position
        self.versions = Versions(spark, f"{self.root}/lists")

    def files(self, version: int | None = None) -> list[str]:
        """The files of a version, by default of the current one, below the folder of data."""
        return sorted(r["path"] for r in self.versions.read(_LIST, version).collect())

    def _rows(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.root}/data/{f}" for f in files))

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.files(version))

    def _written(self, rows: DataFrame) -> list[str]:
        folder = uuid.uuid4().hex
        rows.repartitionByRange(col(self.key)).write.parquet(f"{self.root}/data/{folder}")
        found = self.spark.read.schema(self.schema).parquet(f"{self.root}/data/{folder}").inputFiles()
        return [f"{folder}/{f.rpartition('/')[2]}" for f in found]

    def _commit(self, files: list[str]) -> int:
        return self.versions.replace(self.spark.createDataFrame([(f,) for f in files], _LIST).coalesce(1))

    def replace(self, rows: DataFrame) -> int:
        """Makes ``rows`` the table; the new version."""
        return self._commit(self._written(rows))

    def touched(self, keys: DataFrame) -> list[str]:
        """The files that hold one of the ``keys``."""
        files = self.files()
        if not files:
            return []
        (name,) = free([self.key], "file")
        held = self._rows(files).select(col(self.key), F.col("_metadata.file_path").alias(name))
        found = held.join(keys.select(col(self.key)).distinct(), self.key, "left_semi").select(F.regexp_extract(col(name), "/data/([^/]+/[^/]+)$", 1).alias("path"))
        return sorted(r["path"] for r in found.distinct().collect())

    def merge(self, new: DataFrame) -> int:
        """Puts the rows of ``new`` in place of those with their key, as ``records.upsert`` does; the new version."""
        touched = self.touched(new)
        end = self.read().agg(F.max(col(self.position))).first()[0]  # of the whole table: new keys come after it
        put = upsert(self._rows(touched), new, self.key, self.position, end)
        return self._commit([f for f in self.files() if f not in set(touched)] + self._written(put))

    def delete(self, keys: DataFrame) -> int:
        """Takes out the rows of the ``keys``; keys that aren't there are ignored; the new version."""
        touched = self.touched(keys)
        left = self._rows(touched).join(keys.select(col(self.key)).distinct(), self.key, "left_anti")
        return self._commit([f for f in self.files() if f not in set(touched)] + (self._written(left) if touched else []))
