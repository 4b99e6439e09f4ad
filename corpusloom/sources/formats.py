"""Tables in the file formats that Spark has itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Formats, with what keeps values as they are: a null apart from an empty text, and fields that are null.
OPTIONS: dict[str, dict[str, str]] = {
    "parquet": {},
    "orc": {},
    "json": {"ignoreNullFields": "false"},
    "csv": {"header": "true", "nullValue": "\\N", "escape": '"', "multiLine": "true"},
}


def write_table(rows: DataFrame, kind: str, path: str) -> None:
    """One file a task."""
    rows.write.format(kind).options(**OPTIONS[kind]).save(path)


def read_table(spark: SparkSession, kind: str, path: str, schema: T.StructType) -> DataFrame:
    """The rows at ``path`` under a stated schema, so nothing is read to guess it; a row that doesn't fit fails the job."""
    modes = {"mode": "FAILFAST"} if kind in ("json", "csv") else {}
    return spark.read.format(kind).schema(schema).options(**OPTIONS[kind], **modes).load(path)


def round_trip(rows: DataFrame, kind: str, path: str) -> DataFrame:
    """``rows`` as they come back from ``path``."""
    write_table(rows, kind, path)
    return read_table(rows.sparkSession, kind, path, rows.schema)
