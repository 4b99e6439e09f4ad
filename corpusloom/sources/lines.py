"""Line files, JSONL files and keyed JSON documents: reading, writing, versioned replacement."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import clip, iso_utc, safe_name

_EDGES = r"(?U)^\s+|\s+$"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in whatever store it names."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_number, value) of all lines, numbered from 1 within their file.

    A file is read in blocks; the lines of each are counted, and those of the blocks before are added, so no line is moved
    and no task sees more of a file than its block.
    """
    where = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block")
    lines = spark.read.text(path).select("value", *where).withColumn("_at", F.monotonically_increasing_id())
    blocks = lines.groupBy("file", "_block").agg(F.count("*").alias("_n"), F.min("_at").alias("_from"))
    earlier = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    number = F.col("_before") + F.col("_at") - F.col("_from") + 1
    return lines.join(blocks, ["file", "_block"]).select("file", number.alias("line_number"), "value")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_number, text, sha256) of the lines that aren't blank or comments; physical numbers, from 1.

    A missing file is an error, and so is one without such a line.
    """
    text = F.regexp_replace("value", _EDGES, "")
    lines = physical_lines(spark, path).select("line_number", text.alias("text"))
    lines = lines.filter((F.col("text") != "") & ~F.col("text").startswith("#")).withColumn("sha256", F.sha2("text", 256))
    if lines.isEmpty():
        raise ValueError(f"no lines in {path}")
    return lines


def read_lines_if_there(spark: SparkSession, path: str) -> DataFrame:
    """(text) of the lines that aren't blank or comments; none if the file is missing."""
    if not exists(spark, path):
        return spark.createDataFrame([], "text string")
    lines = spark.read.text(path).select(F.regexp_replace("value", _EDGES, "").alias("text"))
    return lines.filter((F.col("text") != "") & ~F.col("text").startswith("#"))


def count_lines(spark: SparkSession, path: str) -> int:
    """All physical lines; 0 if the file is missing."""
    return spark.read.text(path).count() if exists(spark, path) else 0


def _is_object(value: Column) -> Column:
    return F.schema_of_variant(F.try_parse_json(value)).startswith("OBJECT")


def read_jsonl_strict(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The objects of a JSONL file; a line that isn't JSON fails the job, other JSON values are left out."""
    lines = spark.read.text(path).filter(~F.col("value").rlike(r"^\s*$"))
    broken = F.raise_error(F.concat(F.lit("not JSON: "), F.substring("value", 1, 80)))
    checked = lines.withColumn("object", F.when(F.try_parse_json("value").isNull(), broken.cast("boolean")).otherwise(_is_object(F.col("value"))))
    return checked.filter("object").select(F.from_json("value", schema).alias("r")).select("r.*")


def read_jsonl_lenient(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(records, dead letters): lines that aren't JSON objects go to the second, with a reason."""
    lines = spark.read.text(path).filter(~F.col("value").rlike(r"^\s*$"))
    good = F.coalesce(_is_object(F.col("value")), F.lit(False))
    records = lines.filter(good).select(F.from_json("value", schema).alias("r")).select("r.*")
    reason = F.when(F.try_parse_json("value").isNull(), "not JSON").otherwise("not an object")
    return records, lines.filter(~good).select("value", reason.alias("reason"))


def dead_letters(bad: DataFrame, attempt: int, context: dict[str, str], now: Column | None = None) -> DataFrame:
    """The second table of ``read_jsonl_lenient`` as a log: created_at, attempt, error_type, error, context (JSON).

    ``now`` may be given, so that reruns agree; it is one time for all rows.
    """
    error = F.concat("reason", F.lit(": "), clip(F.col("value"), 80))
    about = F.to_json(F.create_map(*(F.lit(x) for item in sorted(context.items()) for x in item)))
    return bad.select(
        iso_utc(F.current_timestamp() if now is None else now).alias("created_at"), F.lit(attempt).alias("attempt"),
        F.regexp_replace("reason", " ", "_").alias("error_type"), error.alias("error"), about.alias("context"),
    )


def append_jsonl(rows: DataFrame, path: str) -> None:
    """One file a task; fields that are null are kept."""
    rows.write.mode("append").option("ignoreNullFields", "false").json(path)


class Versions:
    """A table in numbered versions below one folder: the last committed is current, those before are the backups.

    A version is a folder of JSON files, and the commit a small file with its number, put there by a rename once the
    folder is complete. A reader never sees a half-written version, and a failed writer leaves the current one as it was.
    The rename is atomic on HDFS; elsewhere let one writer commit at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """The committed versions, in order."""
        folder = self._path(f"{self.root}/commits")
        if not self._fs.exists(folder):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(folder))
        return sorted(int(n) for n in names if n.isdigit())

    def replace(self, rows: DataFrame) -> int:
        """Writes ``rows`` as the next version, which may be made from the current one, and commits it; its number."""
        number = max(self.numbers(), default=0) + 1
        name = f"{number:09d}-{uuid.uuid4().hex}"
        rows.write.option("ignoreNullFields", "false").json(f"{self.root}/data/{name}")
        draft = self._path(f"{self.root}/commits/.{name}")
        out = self._fs.create(draft, False)
        out.write(name.encode())
        out.close()
        final = self._path(f"{self.root}/commits/{number:09d}")
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise RuntimeError(f"version {number} was committed by another writer")
        return number

    def read(self, schema: T.StructType, number: int | None = None) -> DataFrame:
        """The rows of a version, by default the current one; none if nothing was committed yet."""
        known = self.numbers()
        if number is None and not known:
            return self.spark.createDataFrame([], schema)
        number = known[-1] if number is None else number
        if number not in known:
            raise ValueError(f"there is no version {number}")
        name = self.spark.read.text(f"{self.root}/commits/{number:09d}").first()[0]
        return self.spark.read.schema(schema).json(f"{self.root}/data/{name}")


def _document(spark: SparkSession, folder: str, key: str) -> str:
    return f"{folder}/{spark.range(1).select(safe_name(F.lit(key))).first()[0]}.json"


def put_document(spark: SparkSession, folder: str, key: str, value: str) -> None:
    """Stores one JSON document under ``key``, in place of the one that is there; a reader sees either of them whole."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target, draft = path(_document(spark, folder, key)), path(f"{folder}/.{uuid.uuid4().hex}")
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = files.create(draft, False)
    out.write(value.encode())
    out.close()
    context = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = spark.sparkContext._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
    options = spark.sparkContext._jvm.java.lang.reflect.Array.newInstance(rename, 1)
    options[0] = getattr(spark.sparkContext._jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    context.rename(draft, target, options)


def delete_document(spark: SparkSession, folder: str, key: str) -> None:
    """Removes the document under ``key``; there may be none."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_document(spark, folder, key))
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, False)


def find_document(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """The JSON document that is stored under ``key``, as text; no row if there is none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", _document(spark, "", key)[1:]).load(folder)
    return files.select(F.decode("content", "UTF-8").alias("value")).filter(F.try_parse_json("value").isNotNull())


def folder_digest(spark: SparkSession, folder: str) -> str:
    """One hash over names and contents of the files of a folder, by name; contents are hashed where they are read.

    The list of names and hashes, a hundred bytes a file, meets in one place, as one hash in order needs.
    """
    files = spark.read.format("binaryFile").load(folder)
    each = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("hash"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", "hash"))), lambda x: F.concat_ws("\n", x["name"], x["hash"])), "\n")
    return each.agg(F.sha2(listed, 256)).first()[0]
