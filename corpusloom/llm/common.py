"""Shared pieces of the corpus operators: table access, durable checkpoints and byte-level words."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Arrow batches handed to Python stay under this many bytes, whatever the length of single texts.
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` below ``sf_dir``, read by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound the bytes of every Arrow batch, so that batches of very long texts fit in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of this application, which all executors share.

    It lies in the folder named in ``spark.checkpoint.dir``. Where that is unset, a folder of this machine is taken if the
    master is local, as in tests; on a cluster that is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder and read back, with its lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, instead_of: str | None = None) -> tuple[DataFrame, str]:
    """``df`` written to a folder that all executors share and read back, and the folder; ``instead_of``, an earlier one, is removed.

    For loops, whose rounds join what the round before has made: a checkpoint keeps the size that was estimated for it, and the
    estimate of a join is a product, so after some rounds its digits take longer than the join. What is read has its own size.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/round-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    if instead_of:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(instead_of)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return spark.read.schema(df.schema).parquet(folder), folder


def free_names(columns: list[str], *names: str) -> list[str]:
    """``names``, each behind as many underscores as set it apart from all ``columns``, whose case doesn't count."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    """A column's name as Spark's expressions read it, whatever is in it."""
    return "`" + name.replace("`", "``") + "`"


def own_columns(df: DataFrame) -> list[Column]:
    """The columns of ``df`` as they are, to be selected from what was derived from it."""
    return [F.col(quoted(c)) for c in df.columns]


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``df.mapInArrow`` for columns of any names, with dots or like others: ``run`` and Spark see numbered ones."""
    names = [f"c{i}" for i in range(len(schema))]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, names=names)

    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    made = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, schema, strict=True)])
    return plain.mapInArrow(numbered, made).toDF(*schema.names)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def octets(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


#: Maps A-Z to a-z and every byte outside words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` to a space (after lower-casing).
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def item_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of a text; null has none."""
    return text.translate(WORD_BYTES).split() if text else []


def batches_of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches that have rows."""
    return (b for b in rows if b.num_rows)
