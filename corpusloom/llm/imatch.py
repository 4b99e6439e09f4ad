"""I-Match fingerprints over randomised lexicons.

The document frequency of every term is counted over the whole corpus. The lexicon is the terms within a band of it,
LOW to HIGH of all documents; since the frequencies add up to the documents' distinct terms, it has at most (their mean
number) / LOW terms, whatever the corpus, and can be sent to the tasks. A document's distinct lexicon terms are sorted, and
those within each of SUBSETS, seeded random parts of the lexicon, are hashed. Wide parts agree only for nearly equal
texts; narrow ones agree as often as the texts share terms, so likeness falls evenly with what is changed.

Defined cases: a null text is empty; a text without lexicon terms is fingerprinted by all its terms, one without any
term by its bytes, so equal texts always have equal fingerprints and different ones differ; repeated rows each get
theirs; documents of equal id are ordered by text; the next document of a corpus of one is itself; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import batches_of, bounded_batches, durable, item_words, octets, table

#: The band of document frequency, as shares of all documents.
LOW, HIGH = 0.002, 0.05
#: The part of the lexicon in each subset, in 1/256; the first is the whole lexicon.
SUBSETS = (256, *(171,) * 3, *(32,) * 4, *(4,) * 8, *(1,) * 16)
#: Terms whose counts a task holds before it passes them on.
HELD = 400_000
#: Terms that may be sent to all tasks.
SENT_TERMS = 2_000_000
SEED = 42


def term_hashes(text: bytes) -> np.ndarray:
    """The sorted hashes of the distinct terms of ``text``."""
    terms = set(item_words(text))
    return np.sort(np.fromiter(map(xxhash.xxh64_intdigest, terms), dtype=np.uint64, count=len(terms)))


def _table(terms: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(counts, pa.int64())], names=["term", "n"])


def _block_counts(docs: DataFrame, share: float) -> DataFrame:
    """(term, n) of blocks of ``docs`` (text), of terms that ``share`` of a block's rows or more hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        rows = 0

        def block() -> pa.RecordBatch:
            least = max(1, math.ceil(rows * share))
            kept = {t: n for t, n in counts.items() if n >= least}
            return _table(np.fromiter(map(xxhash.xxh64_intdigest, kept), np.uint64, len(kept)), np.fromiter(kept.values(), np.int64, len(kept)))

        for batch in batches:
            for text in octets(batch.column(0)):
                counts.update(set(item_words(text)))
                rows += 1
                if len(counts) >= HELD:
                    yield block()
                    counts.clear()
                    rows = 0
        yield block()

    return docs.select("text").mapInArrow(run, "term bigint, n bigint")


def _exact_counts(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """(term, n) of parts of ``docs`` (text), of the sorted ``terms`` alone."""
    shared = docs.sparkSession.sparkContext.broadcast(terms.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(shared.value, dtype=np.uint64)
        counts = np.zeros(len(known), dtype=np.int64)
        for batch in batches:
            for text in octets(batch.column(0)):
                if text:
                    counts[np.searchsorted(known, _held(known, term_hashes(text)))] += 1
        some = counts > 0
        yield _table(known[some], counts[some])

    return docs.select("text").mapInArrow(run, "term bigint, n bigint")


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> np.ndarray:
    """The sorted hashes of the terms that between ``low`` and ``high`` of the rows of ``docs`` (text) hold.

    A term with that share of all rows has it in one block of rows at least, so only terms that do are counted over the
    corpus. Where their number isn't small, as it may be in corpora of many kinds, all terms are counted in one go.
    """
    bounded_batches(docs.sparkSession)
    total = docs.count()
    likely = durable(_block_counts(docs, low).select("term").distinct())
    if likely.count() <= SENT_TERMS:
        counts = _exact_counts(docs, np.sort(likely.toArrow().column(0).to_numpy().view(np.uint64)))
    else:
        counts = _block_counts(docs, 0.0)
    counts = counts.groupBy("term").agg(F.sum("n").alias("n"))
    band = counts.filter(F.col("n").between(math.ceil(total * low), math.floor(total * high))).select("term").toArrow()
    return np.sort(band.column(0).to_numpy().view(np.uint64))


def _held(lex: np.ndarray, terms: np.ndarray) -> np.ndarray:
    if not len(lex) or not len(terms):
        return terms[:0]
    at = np.minimum(np.searchsorted(lex, terms), len(lex) - 1)
    return terms[lex[at] == terms]


def fingerprint(text: bytes, lex: np.ndarray) -> np.ndarray:
    """A hash of 16 bits for each subset; 0 where the text has no term of it."""
    terms = term_hashes(text)
    kept = _held(lex, terms)
    if not len(kept):
        kept = terms if len(terms) else np.array([xxhash.xxh64_intdigest(text, SEED)], dtype=np.uint64)
    out = np.zeros(len(SUBSETS), dtype=np.uint16)
    for k, part in enumerate(SUBSETS):
        if part == 256:
            own = kept
        else:
            mixed = (kept ^ np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xD6E8FEB86659FD93)
            own = kept[(mixed >> np.uint64(56)) < np.uint64(part)]
        if len(own):
            out[k] = 1 + xxhash.xxh32_intdigest(own.tobytes(), SEED + k) % 0xFFFF
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of subsets with equal hashes, of those in which either text has terms."""
    either = (a | b) != 0
    return float(((a == b) & either).sum() / either.sum())


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_ROW = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_ROW_TYPE = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
_EDGE = f"{_ROW}, part int, edge string, edge_text string"
_EDGE_TYPE = pa.schema([*_ROW_TYPE, ("part", pa.int32()), ("edge", pa.string()), ("edge_text", pa.string())])


def _text(prints: np.ndarray) -> str:
    return prints.astype(">u2").tobytes().hex()


def _compared(doc_id: int | None, text: str, own: np.ndarray, following: str, next_: np.ndarray, lex: np.ndarray) -> dict:
    changed = edited(text, following).encode()
    prints = fingerprint(changed, lex)
    return {
        "doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(changed).hexdigest(), "fingerprint": _text(own),
        "edited_fingerprint": _text(prints), "near_edited": likeness(own, prints), "near_next": likeness(own, next_),
    }


def _in_order(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """Rows of sorted parts compared with the row after; the first and last row of a part are marked as edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = np.frombuffer(shared.value, dtype=np.uint64)
        before = None
        for batch in batches_of(batches):
            part, rows = batch.column(2)[0].as_py(), []
            for doc_id, raw in zip(batch.column(0).to_pylist(), octets(batch.column(1)), strict=True):
                raw = raw or b""
                text, prints = raw.decode(), fingerprint(raw, lex)
                if before is None:
                    rows.append({"part": part, "edge": "first", "edge_text": text})
                else:
                    rows.append(_compared(*before, text, prints, lex))
                before = doc_id, text, prints
            yield pa.RecordBatch.from_pylist(rows, schema=_EDGE_TYPE)
        if before is not None:
            last = {"doc_id": before[0], "part": part, "edge": "last", "edge_text": before[1]}
            yield pa.RecordBatch.from_pylist([last], schema=_EDGE_TYPE)

    ordered = docs.repartitionByRange(F.desc_nulls_last("doc_id"))
    ordered = ordered.sortWithinPartitions(F.desc_nulls_last("doc_id"), "text").withColumn("part", F.spark_partition_id())
    return ordered.mapInArrow(run, _EDGE)


def _across(pairs: DataFrame, shared: Broadcast) -> DataFrame:
    """The comparison for (doc_id, text, following)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = np.frombuffer(shared.value, dtype=np.uint64)
        for batch in batches_of(batches):
            rows = [
                _compared(i, a, fingerprint(a.encode(), lex), b, fingerprint(b.encode(), lex), lex)
                for i, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True)
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=_ROW_TYPE)

    return pairs.mapInArrow(run, _ROW)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with its fingerprint and its likeness to its edited text and the next document.

    Documents are dealt to parts by ranges of doc_id; what crosses from one part to the next is one text a part.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(lexicon(docs).tobytes())
    rows = durable(_in_order(docs, shared))
    edges = rows.filter("edge IS NOT NULL")
    firsts, lasts = edges.filter("edge = 'first'"), edges.filter("edge = 'last'")
    parts = firsts.select("part")
    follower = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy()))
    follows = parts.select(F.col("part"), follower.alias("next_part"))
    pairs = lasts.select("part", "doc_id", F.col("edge_text").alias("text")).join(follows, "part").join(
        firsts.select(F.col("part").alias("next_part"), F.col("edge_text").alias("following")), "next_part"
    )
    done = rows.filter("edge IS NULL").select(*_ROW_TYPE.names)
    return done.unionByName(_across(pairs.select("doc_id", "text", "following"), shared))


def op5_fingerprints_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))
