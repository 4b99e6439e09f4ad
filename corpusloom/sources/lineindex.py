"""A sparse index of line files: a page of a huge file reads the blocks that hold it, and no others.

A block is a run of lines of one file, at most ``every``; an entry has its first byte, its length, the number of its first line,
and how many of its lines, and of those before it, aren't blank. Entries are counted where the lines are read, so only they are
shuffled; what lies before a block is summed over the splits of its file first and then within a split, so no task has all
entries of a large file. A page finds its blocks by these counts, and tasks read just their bytes.

Files don't change once they are indexed; ``extend`` adds those that have come. Lines end at a line feed. They are numbered from 1
in their file, and the files of a folder follow one another by name. A file that isn't plain text, such as a compressed one, is
an error, as its bytes can't be found by their place. Blocks are read by pyarrow, so from the file systems that it knows; bytes that aren't
UTF-8 come as replacement characters. Empty files have no entry.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.sources.lines import exists

#: Lines of a block, and lines and bytes of a batch that a task gives out.
EVERY = 1000
BATCH_LINES, BATCH_BYTES = 1000, 8 << 20
_READ = "file string, line_number long, place long, value string"
_BLANK = b" \t\n\x0b\x0c\r"


def _lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of blocks; ``place`` counts lines that aren't blank from the end, and is null for blank ones."""
    from pyarrow.fs import FileSystem

    rows: list[tuple[str, int, int | None, str]] = []
    held = 0

    def batch() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["file", "line_number", "place", "value"])

    for blocks in batches:
        for b in blocks.to_pylist():
            store, path = FileSystem.from_uri(b["file"])
            with store.open_input_file(path) as raw:
                raw.seek(b["start"])
                reader, place = io.BufferedReader(raw, 1 << 20), b["after"] + b["n_texts"] - 1
                for k in range(b["n_lines"]):
                    line = reader.readline().removesuffix(b"\n")
                    full = bool(line.strip(_BLANK))
                    rows.append((b["file"], b["first_line"] + k, place if full else None, line.decode(errors="replace")))
                    place, held = place - full, held + len(line)
                    if len(rows) >= BATCH_LINES or held >= BATCH_BYTES:
                        yield batch()
                        rows, held = [], 0
    if rows:
        yield batch()


class LineIndex:
    def __init__(self, spark: SparkSession, root: str, every: int = EVERY):
        self.spark, self.root, self.every = spark, root.rstrip("/"), every

    def extend(self, path: str) -> int:
        """Adds the files at ``path`` that the index doesn't have; how many. Their names pass through the driver, as in a listing.

        Entries lie in a folder of their own until the list of files names it, so a failed call leaves the index as it was.
        """
        listed = self.spark.read.format("binaryFile").load(path).select("path", F.col("_metadata.file_path").alias("file")).filter("length > 0")
        if exists(self.spark, f"{self.root}/files"):
            listed = listed.join(self._files().select("file"), "file", "left_anti")
        new = sorted(r["path"] for r in listed.collect())
        if not new:
            return 0
        batch = uuid.uuid4().hex
        counted, blocks = f"{self.root}/counted/{batch}", f"{self.root}/blocks/batch={batch}"
        self._counted(new).write.parquet(counted)
        self._placed(self.spark.read.parquet(counted)).write.parquet(blocks)
        sums = self.spark.read.parquet(blocks).groupBy("file").agg(F.sum("n_lines").alias("n_lines"), F.sum("n_texts").alias("n_texts"))
        sums.withColumn("batch", F.lit(batch)).write.mode("append").parquet(f"{self.root}/files")
        return len(new)

    def _counted(self, files: list[str]) -> DataFrame:
        """One row a block, without what lies before it."""
        about = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("split")
        lines = self.spark.read.option("lineSep", "\n").text(files).select("value", *about).withColumn("at", F.monotonically_increasing_id())
        run = F.floor(F.col("at") / self.every)  # ids rise by one within a split
        return lines.groupBy("file", "size", "split", run.alias("run")).agg(
            F.min("at").alias("at"), F.count("*").alias("n_lines"), F.count_if(~F.col("value").rlike(r"^\s*$")).alias("n_texts"),
            F.sum(F.octet_length("value") + 1).alias("bytes"),
        )

    def _placed(self, counted: DataFrame) -> DataFrame:
        sums = ("n_lines", "n_texts", "bytes")
        splits = counted.groupBy("file", "size", "split").agg(*(F.sum(c).alias(c) for c in sums))
        earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
        # A last line need not end in a line feed, and the three bytes that mark UTF-8 aren't a part of the first line.
        left = F.col("size") - F.sum("bytes").over(Window.partitionBy("file"))
        broken = F.raise_error(F.concat(F.lit("not a plain text file: "), "file")).cast("bigint")
        mark = F.when(left.isin(0, -1), 0).when(left.isin(2, 3), 3).otherwise(broken)
        before = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"split_{c}") for c in sums]
        splits = splits.select("file", "split", mark.alias("mark"), *before)
        within = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        lines, texts, start = (F.coalesce(F.sum(c).over(within), F.lit(0)) + F.col(f"split_{c}") for c in sums)
        return counted.join(splits, ["file", "split"]).select(
            "file", (start + F.col("mark")).alias("start"), (lines + 1).alias("first_line"), "n_lines", texts.alias("before"), "n_texts"
        )

    def _files(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/files")

    def _blocks(self, files: DataFrame) -> DataFrame:
        """The blocks of ``files`` (file, batch and others), a few, of which the batches are looked up."""
        batches = [r["batch"] for r in files.select("batch").distinct().collect()]
        if not batches:
            return self.spark.createDataFrame([], "file string, start long, first_line long, n_lines long, before long, n_texts long, after long")
        blocks = self.spark.read.parquet(f"{self.root}/blocks").filter(F.col("batch").isin(batches)).drop("batch")
        return blocks.join(files.select("file", "after", F.col("n_texts").alias("of")), "file").withColumn(
            "after", F.col("after") + F.col("of") - F.col("before") - F.col("n_texts")
        )

    def total(self) -> int:
        """All lines that aren't blank."""
        return self._files().agg(F.coalesce(F.sum("n_texts"), F.lit(0))).first()[0]

    def blocks_of_page(self, offset: int, limit: int) -> DataFrame:
        """The blocks that hold a page: those with a line whose place from the end is in it.

        The places of files come from one row a file; of a page of ``limit`` lines at most as many files are asked for.
        """
        later = Window.orderBy(F.desc("file")).rowsBetween(Window.unboundedPreceding, -1)
        files = self._files().withColumn("after", F.coalesce(F.sum("n_texts").over(later), F.lit(0)))
        held = (F.col("after") < offset + limit) & (F.col("after") + F.col("n_texts") > offset)
        return self._blocks(files.filter(held)).filter(held)

    def read(self, blocks: DataFrame) -> DataFrame:
        """(file, line_number, place, value) of all lines of blocks, each of which is a part of one task."""
        return blocks.select("file", "start", "first_line", "n_lines", "n_texts", "after").mapInArrow(_lines_of, _READ)

    def page(self, offset: int, limit: int, most: int = 500) -> DataFrame:
        """(place, file, line_number, value, total) of a page, the last line first; ``limit`` is held between 1 and ``most``.

        As in ``records.page_of_lines``, blank lines don't count, and lines that aren't JSON objects go after the page was cut.
        """
        offset, limit = max(0, offset), max(1, min(limit, most))
        lines = self.read(self.blocks_of_page(offset, limit)).filter((F.col("place") >= offset) & (F.col("place") < offset + limit))
        object_ = F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))
        return lines.filter(object_).select("place", "file", "line_number", "value", F.lit(self.total()).alias("total"))

    def between(self, file: str, first: int, last: int) -> DataFrame:
        """(line_number, value) of the lines ``first`` to ``last`` of a file of the index."""
        files = self._files().filter(F.col("file") == file).withColumn("after", F.lit(0).cast("bigint"))
        held = (F.col("first_line") <= last) & (F.col("first_line") + F.col("n_lines") > first)
        lines = self.read(self._blocks(files).filter(held))
        return lines.filter(F.col("line_number").between(first, last)).select("line_number", "value")
