r"""Lines that many documents share, told as compressed bitmaps of the lines that each document keeps.

A text is split at ``\n``. The key of a line is the line without ASCII white space at both ends, A-Z lower-cased; keys of
LEAST_CHARS code points or more that LEAST_DOCS documents hold lose all their lines but those in the document of the
largest doc_id. Only 128-bit hashes of keys move, with doc_id and position, never the lines.

The hashes are range-partitioned and sorted by hash, then by document, largest doc_id first, then by position. A range is
streamed: the first document of a hash is the one that keeps it, and up to LEAST_DOCS documents wait until it is known
whether the others lose it. The ranges are cut by document and position, too, so a line in a third of all documents
lies in as many ranges as its share of rows. What such ranges say of a hash that they share, its documents and the first of
them, is put together from two entries a range, which is all that passes through the driver. Positions then meet by
document as the bitmap of its lines; documents that keep all have none.

Defined cases: a null or empty text is one empty line; rows of one doc_id are one document, those without doc_id are one, too,
smaller than all others; repeated rows have equal bitmaps, and rows of one doc_id with different texts one each; texts of any
length are split whole, and a document's positions meet in one task; an empty table gives no rows; columns of any names are
kept by ``with_bitmaps`` and ``drop_repeated_lines``. Texts of one doc_id are told apart by hashes of 64 bits.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import batches_of, bounded_batches, durable, free_names, map_batches, octets, own_columns, quoted, table
from corpusloom.llm.simhash import text_hash

#: Code points of a key, and documents that hold it, from which its lines go.
LEAST_CHARS, LEAST_DOCS = 40, 5

_LINES = "h1 bigint, h2 bigint, doc_id bigint, text_hash bigint, pos int, n_lines int"
_LOST = "doc_id bigint, text_hash bigint, pos int, n_lines int"


def line_key(line: bytes) -> bytes:
    r"""The line without ``[\x20\x09-\x0D]`` at both ends, A-Z lower-cased: bytes know ASCII only."""
    return line.strip().lower()


def _long(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def line_hashes(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(h1, h2, doc_id, text_hash, pos, n_lines) of each line of ``docs`` (doc_id, text) whose key is long enough."""
    names = [f.name for f in T.StructType.fromDDL(_LINES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            digests, rows, places, sizes = [], [], [], []
            for i, text in enumerate(octets(batch.column(1))):
                lines = (text or b"").split(b"\n")
                sizes.append(len(lines))
                for pos, line in enumerate(lines):
                    key = line_key(line)
                    if _long(key, least_chars):
                        digests.append(xxhash.xxh3_128_digest(key))
                        rows.append(i)
                        places.append(pos)
            at = np.array(rows, dtype=np.int64)
            hashes = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            made = [pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), batch.column(0).take(pa.array(at)), batch.column(2).take(pa.array(at))]
            made += [pa.array(np.array(places, dtype=np.int32)), pa.array(np.array(sizes, dtype=np.int32)[at])]
            yield pa.RecordBatch.from_arrays(made, names=names)

    bounded_batches(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("bigint"), F.col("text"), text_hash(F.col("text")).alias("text_hash"))
    return plain.mapInArrow(run, _LINES)


@dataclass
class Run:
    """A hash's rows so far in a range: documents, the first and the last of them."""

    key: tuple[int, int] | None = None
    docs: int = 0
    first: int | None = None
    last: int | None = None
    waiting: list[tuple] = field(default_factory=list)

    def take(self, doc: int | None) -> None:
        if not self.docs:
            self.first = doc
        if not self.docs or doc != self.last:
            self.docs += 1
        self.last = doc


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches_of(batches):
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last run of a range: (part, place: 0 or 1, h1, h2, docs, first, last)."""
    ends, run = [], Run()
    for h1, h2, doc, *_ in _rows(batches):
        if (h1, h2) != run.key:
            if run.key is not None and not ends:
                ends.append(run)
            run = Run((h1, h2))
        run.take(doc)
    if run.key is not None:
        part = TaskContext.get().partitionId()
        rows = [(part, i, *r.key, r.docs, r.first, r.last) for i, r in enumerate([*ends, run])]
        columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "place", "h1", "h2", "docs", "first", "last"])


def shared_runs(ends: list[tuple]) -> dict[int, dict[tuple[int, int], tuple[int, int | None]]]:
    """For each range, the documents and the first document of its first and last hash over all ranges, from the ``ends`` in order.

    A document whose lines of one hash lie in two ranges counts once: it is the last of one and the first of the next.
    """
    totals: dict[tuple[int, int], list] = {}
    for _, _, h1, h2, docs, first, last in ends:
        seen = totals.setdefault((h1, h2), [0, first, None])
        seen[0] += docs - (seen[0] > 0 and seen[2] == first)
        seen[2] = last
    out: dict[int, dict] = {}
    for part, _, h1, h2, *_ in ends:
        docs, first, _ = totals[h1, h2]
        out.setdefault(part, {})[h1, h2] = docs, first
    return out


def _lost(shared: dict, least_docs: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Maps the sorted rows of a range to those that go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = shared.get(TaskContext.get().partitionId(), {}), Run()
        keeper, goes, out = None, None, []
        for h1, h2, doc, *rest in _rows(batches):
            if (h1, h2) != seen.key:
                seen = Run((h1, h2))
                keeper, goes = doc, None  # whether the others lose it is known once enough documents have come
                if seen.key in known:
                    docs, keeper = known[seen.key]
                    goes = docs >= least_docs
            seen.take(doc)
            if goes is None and seen.docs >= least_docs:
                goes = True
                out += seen.waiting
            if doc != keeper:
                if goes:
                    out.append((doc, *rest))
                elif goes is None:
                    seen.waiting.append((doc, *rest))
            if len(out) >= 1 << 16:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "pos", "n_lines"])


def pack(n_lines: int, lost: list[int]) -> bytes:
    """The bitmap of ``n_lines`` lines, compressed: a bit is 1 where the line stays."""
    keep = np.ones(n_lines, dtype=bool)
    keep[lost] = False
    return zlib.compress(np.packbits(keep).tobytes(), 6)


def unpack(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(doc_id, text_hash, n_lines, n_dropped, keep: compressed bitmap) of each text of ``docs`` that loses lines."""
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc_nulls_last(), F.col("text_hash"), F.col("pos")]
    held = durable(line_hashes(docs, least_chars))  # so that texts aren't split once more to find the ranges
    ranges = durable(held.repartitionByRange(*order).sortWithinPartitions(*order))
    ends = ranges.mapInArrow(_ends, "part bigint, place bigint, h1 bigint, h2 bigint, docs bigint, first bigint, last bigint")
    shared = shared_runs(sorted((tuple(r) for r in ends.collect()), key=lambda r: r[:2]))
    lost = ranges.mapInArrow(_lost(shared, least_docs), _LOST)
    # A set, as repeated rows lose the same lines; partial sets are made before the shuffle.
    marked = lost.groupBy("doc_id", "text_hash").agg(F.max("n_lines").alias("n_lines"), F.collect_set("pos").alias("lost"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            gone = batch.column(3).to_pylist()
            bits = [pack(n, x) for n, x in zip(batch.column(2).to_pylist(), gone, strict=True)]
            many = pa.array([len(x) for x in gone], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], many, pa.array(bits, pa.binary())], names=["doc_id", "text_hash", "n_lines", "n_dropped", "keep"])

    return durable(marked.mapInArrow(packed, "doc_id bigint, text_hash bigint, n_lines int, n_dropped int, keep binary"))


def with_bitmaps(docs: DataFrame, name: str = "keep", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``docs`` with the compressed bitmap of the lines that stay under ``name``; null where all do."""
    own, same_id, same_hash, bits = free_names([*docs.columns, name], "_text_hash", "_same_id", "_same_hash", "_bits")
    maps = keep_bitmaps(docs.select("doc_id", "text"), least_chars, least_docs)
    maps = maps.select(F.col("doc_id").alias(same_id), F.col("text_hash").alias(same_hash), F.col("keep").alias(bits))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(same_id)) & (F.col(own) == F.col(same_hash))
    kept = [F.col(quoted(c)) for c in docs.columns if c.lower() != name.lower()]
    return docs.withColumn(own, text_hash(F.col("text"))).join(maps, same, "left").select(*kept, F.col(bits).alias(name))


def kept_text(text: bytes | None, bitmap: bytes | None) -> tuple[int, int, bytes]:
    """Lines, lines that go, and the lines that stay, joined."""
    lines = (text or b"").split(b"\n")
    if bitmap is None:
        return len(lines), 0, text or b""
    keep = unpack(bitmap, len(lines))
    return len(lines), len(lines) - int(keep.sum()), b"\n".join(x for x, k in zip(lines, keep.tolist(), strict=True) if k)


def drop_repeated_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``docs`` without the lines that go; a text that loses none, null ones too, is as it was. All columns are kept."""
    (name,) = free_names(docs.columns, "_keep")
    marked = with_bitmaps(docs, name, least_chars, least_docs)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            bits = batch.column(batch.num_columns - 1).to_pylist()
            texts = [t if b is None else kept_text(t, b)[2] for t, b in zip(octets(batch.column(at)), bits, strict=True)]
            columns = batch.columns[:-1]
            columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=[str(i) for i in range(len(columns))])

    bounded_batches(docs.sparkSession)
    return map_batches(marked.select(*own_columns(docs), name), run, docs.schema)


def op11_lines_keep_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = with_bitmaps(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            told = [kept_text(t, b) for t, b in zip(octets(batch.column(1)), batch.column(2).to_pylist(), strict=True)]
            columns = [pa.array([x[i] for x in told], pa.int64()) for i in (0, 1)]
            digests = pa.array([hashlib.sha256(x[2]).hexdigest() for x in told], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, digests], names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    bounded_batches(spark)
    return marked.mapInArrow(run, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string")


_KEY = r"regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"
OP11_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
each AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM docs),
keyed AS (SELECT r, doc_id, line, pos, {_KEY} AS key FROM each),
shared AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE len(key) >= {LEAST_CHARS}
           GROUP BY key HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= {LEAST_DOCS}),
marked AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id IS DISTINCT FROM s.keeper AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""
