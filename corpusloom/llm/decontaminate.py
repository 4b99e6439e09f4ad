"""Benchmark decontamination: an FM-index of words per training shard, searched backwards for test windows.

The benchmark's windows (ten consecutive words of an item; an item of fewer words is one window) travel to the tasks;
each task cuts its documents into shards, makes an FM-index of a shard's words, finds the windows' occurrences
by backward search, locates them through sampled suffix positions and merges them to spans. The alphabet of an index
is the benchmark's vocabulary; every other word is one symbol that no window contains. Documents are not shuffled.

A benchmark of over BLOCK_BYTES of text is searched in blocks of items, so that what the driver and an executor hold is
bounded; what the blocks find is merged text by text.

Defined cases: a null text has no words and stays null; an item without words has no window; items that share an id count
once; a null item id counts as the empty string; equal texts of a shard are indexed once and reported for each row; an
empty table gives no rows; all columns of the documents, and no others, are returned by ``remove_benchmark``, which
chooses the names it needs apart from them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain, repeat
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import WORD_BYTES, batches_of, bounded_batches, durable, free_names, item_words, map_batches, octets, own_columns, quoted, table
from corpusloom.llm.fmindex import FMIndex

WINDOW = 10
#: Bytes of benchmark items that are searched at once.
BLOCK_BYTES = 12 << 20
#: Bytes of text in a shard.
SHARD_BYTES = 12 << 20
#: Symbols of the index that are not benchmark words: the end of a document and any other word.
END, OTHER = 0, 1


def _same(row: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For windows (places in ``row``) a number that equal ones share, from words joined one at a time to what stands before them."""
    many = int(row.max(initial=0)) + 1
    number = np.zeros(len(ends), dtype=np.int64)
    for back in range(int(lengths.max(initial=0))):
        symbol = np.where(lengths > back, row[np.maximum(ends - 1 - back, 0)], 0)
        number = np.unique(number * many + symbol, return_inverse=True)[1]
    return number


class Phrases:
    """The distinct windows of a block of benchmark items: places in the row of all words of the items, which are symbols."""

    def __init__(self, items: list[tuple[str, bytes]]):
        self.ids = sorted({i for i, _ in items})
        number = {x: k for k, x in enumerate(self.ids)}
        self.symbols: dict[bytes, int] = {}
        pieces = [np.zeros(0, dtype=np.int32)]
        for _, text in items:
            words = item_words(text)
            pieces.append(np.fromiter((self.symbols.setdefault(w, len(self.symbols) + 2) for w in words), dtype=np.int32, count=len(words)))
        self.row = np.concatenate(pieces)
        sizes = np.array([len(p) for p in pieces[1:]], dtype=np.int64)
        many = np.where(sizes > 0, np.maximum(sizes - WINDOW, 0) + 1, 0)
        starts = np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(many) - many), many) + np.arange(many.sum())
        lengths = np.repeat(np.minimum(sizes, WINDOW), many)
        _, first, same = np.unique(_same(self.row, starts + lengths, lengths), return_index=True, return_inverse=True)
        self.lengths = lengths[first]
        self.ends = starts[first] + self.lengths
        owner = np.repeat(np.array([number[i] for i, _ in items], dtype=np.int64), many)
        owned = np.unique(same * max(len(self.ids), 1) + owner)
        self.owners = owned % max(len(self.ids), 1)
        self.first = np.searchsorted(owned, np.arange(len(first) + 1) * max(len(self.ids), 1))

    @property
    def windows(self) -> np.ndarray:
        """The windows themselves, one a row, right-aligned behind zeros."""
        back = np.arange(WINDOW, 0, -1)
        return np.where(self.lengths[:, None] >= back, self.row[np.maximum(self.ends[:, None] - back, 0)], 0)


def search_shard(texts: list[bytes], phrases: Phrases | SimpleNamespace) -> tuple[np.ndarray, list[np.ndarray], list[list[int]]]:
    """For each text its number of words, a mask of hit words (empty if none is) and the numbers of the items found."""
    get, pieces = phrases.symbols.get, []
    sizes = np.zeros(len(texts), dtype=np.int64)
    for k, text in enumerate(texts):
        words = item_words(text)
        sizes[k] = len(words)
        pieces.append(np.fromiter(map(get, words, repeat(OTHER)), dtype=np.int32, count=len(words)))
        pieces.append(np.zeros(1, dtype=np.int32))
    masks = [np.zeros(0, dtype=bool)] * len(texts)
    items: list[list[int]] = [[] for _ in texts]
    if not len(phrases.ends) or not sizes.any():
        return sizes, masks, items
    starts = np.r_[0, np.cumsum(sizes + 1)]
    index = FMIndex(np.concatenate(pieces), len(phrases.symbols) + 2)
    low, high = index.search_places(phrases.row, phrases.ends, phrases.lengths)
    found = np.flatnonzero(low < high)
    many = (high - low)[found]
    window = np.repeat(found, many)
    if not len(window):
        return sizes, masks, items
    rows = np.repeat(low[found] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    place = index.locate(rows)
    edge = np.zeros(index.n + 1, dtype=np.int64)
    np.add.at(edge, place, 1)
    np.add.at(edge, place + phrases.lengths[window], -1)
    hit = np.cumsum(edge[:-1]) > 0
    doc = np.searchsorted(starts, place, side="right") - 1
    owned = phrases.first[window + 1] - phrases.first[window]
    item = phrases.owners[np.repeat(phrases.first[window] - (np.cumsum(owned) - owned), owned) + np.arange(owned.sum())]
    for k, i in np.unique(np.stack([np.repeat(doc, owned), item], axis=1), axis=0):
        items[k].append(int(i))
    for k in np.unique(doc):
        masks[k] = hit[starts[k] : starts[k] + sizes[k]]
    return sizes, masks, items


def word_runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """The runs of set values as (first, end)."""
    edges = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
    return [(int(a), int(b)) for a, b in edges.reshape(-1, 2)]


def cut_words(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    """``text`` without the bytes from the first to the last word of each run."""
    spans = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(WORD_BYTES))]
    out, at = [], 0
    for a, b in runs:
        out.append(text[at : spans[a][0]])
        at = spans[b - 1][1]
    return b"".join(out) + text[at:]


def _shards(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    begin, room = 0, SHARD_BYTES
    for k, text in enumerate(texts):
        room -= len(text or b"")
        if room < 0 or k + 1 == len(texts):
            yield begin, k + 1
            begin, room = k + 1, SHARD_BYTES


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long item in pieces of about BLOCK_BYTES whose windows are, together, those of the item."""
    if len(text) <= BLOCK_BYTES:
        yield text
        return
    words = item_words(text)
    step = max(WINDOW, BLOCK_BYTES * len(words) // len(text))
    for at in range(0, max(1, len(words) - WINDOW + 1), step):
        yield b" ".join(words[at : at + step + WINDOW - 1])


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of about BLOCK_BYTES of text; the driver holds one block at a time."""
    block, room = [], BLOCK_BYTES
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.col("text").cast("binary"))
    for item, text in rows.filter("text is not null").toLocalIterator():
        for piece in _pieces(bytes(text)):
            block.append((item, piece))
            room -= len(piece)
            if room <= 0:
                yield block
                block, room = [], BLOCK_BYTES
    if block:
        yield block


_RUNS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
_RUNS_DDL = "array<struct<a: int, b: int>>"
#: What one text holds: its words, the runs of words that windows cover, and the items that the windows are of.
Found = tuple[int, list[tuple[int, int]], list[str]]


def _in_shards(texts: list[bytes | None], phrases: Phrases | SimpleNamespace) -> Iterator[list[Found]]:
    """What consecutive texts hold, shard by shard."""
    for a, b in _shards(texts):
        place = {t: k for k, t in enumerate(dict.fromkeys(t or b"" for t in texts[a:b]))}
        sizes, masks, items = search_shard(list(place), phrases)
        found = [(int(n), word_runs(m), [phrases.ids[i] for i in x]) for n, m, x in zip(sizes, masks, items, strict=True)]
        yield [found[place[t or b""]] for t in texts[a:b]]


def _with_found(rows: pa.RecordBatch, texts: list[bytes | None], found: list[Found], text: int | None, names: list[str]) -> pa.RecordBatch:
    """``rows`` and, as ``names``, what their texts hold; the column ``text``, if given, loses the runs."""
    columns = list(rows.columns)
    if text is not None:
        cut = [cut_words(t, runs) if t and runs else t for t, (_, runs, _) in zip(texts, found, strict=True)]
        columns[text] = pa.array(cut, pa.binary()).cast(rows.schema.field(text).type)
    words, runs, items = zip(*found, strict=True) if found else ((), (), ())
    columns += [
        pa.array(words, pa.int64()), pa.array([[{"a": a, "b": b} for a, b in x] for x in runs], _RUNS), pa.array(items, pa.list_(pa.string())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[*rows.schema.names, *names])


def _merged(parts: list[dict] | None) -> tuple[list[tuple[int, int]], list[str]]:
    """The runs of several blocks made one where they overlap or touch, and their items."""
    runs: list[tuple[int, int]] = []
    for a, b in sorted((r["a"], r["b"]) for p in parts or [] for r in p["runs"]):
        if runs and a <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
        else:
            runs.append((a, b))
    return runs, sorted({i for p in parts or [] for i in p["items"]})


def _of_block(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """(key, runs, items) of the texts of ``docs`` (key, text) that hold a window of one block of items."""
    schema = pa.schema([("key", pa.string()), ("runs", _RUNS), ("items", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = SimpleNamespace(**shared.value)  # plain values: workers have no copy of this package
        for batch in batches_of(batches):
            found = [x for shard in _in_shards(octets(batch.column(1)), phrases) for x in shard]
            some = {key: x for key, x in zip(batch.column(0).to_pylist(), found, strict=True) if x[2]}
            rows = [{"key": k, "runs": [{"a": a, "b": b} for a, b in runs], "items": items} for k, (_, runs, items) in some.items()]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return docs.mapInArrow(run, f"key string, runs {_RUNS_DDL}, items array<string>")


def find_benchmark(docs: DataFrame, benchmark: DataFrame, keep: list[str], cut: bool = False) -> tuple[DataFrame, list[str]]:
    """The columns ``keep`` of ``docs`` (with a column text) with three more, and the names of these.

    They hold the number of words, the runs of hit words and the ids of the items found. With ``cut``, the texts lose the
    runs. A benchmark of one block is broadcast, and documents stay where they are. One of more blocks is searched block
    by block: what each finds is written, by text, and its broadcast is given up before the next is made, so neither the
    driver nor an executor holds more than one block.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    names = free_names(keep, "_words", "_runs", "_items")
    text, key, parts = free_names([*keep, *names], "_text", "_key", "_parts")
    added = T.StructType.fromDDL(f"{names[0]} bigint, {names[1]} {_RUNS_DDL}, {names[2]} array<string>")
    schema = T.StructType([*(docs.schema[c] for c in keep), *added.fields])
    at = keep.index("text") if cut else None
    held = docs.select(*(F.col(quoted(c)) for c in keep), F.col("text").alias(text))
    blocks = _blocks(benchmark)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        shared = spark.sparkContext.broadcast(vars(Phrases(first)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            phrases = SimpleNamespace(**shared.value)
            for batch in batches_of(batches):
                texts, begin = octets(batch.column(len(keep))), 0
                for found in _in_shards(texts, phrases):
                    rows = batch.slice(begin, len(found)).select(range(len(keep)))
                    yield _with_found(rows, texts[begin : begin + len(found)], found, at, names)
                    begin += len(found)

        return map_batches(held, run, schema), names

    texts_only = docs.select(_text_key(F.col("text")).alias("key"), "text")
    found_parts = []
    for block in chain((first, second), blocks):
        shared = spark.sparkContext.broadcast(vars(Phrases(block)))
        found_parts.append(durable(_of_block(texts_only, shared)))
        shared.destroy()
    # A text of very many rows comes once from each batch, and the sets are made in part before the shuffle.
    found = reduce(DataFrame.unionAll, found_parts).groupBy(F.col("key").alias(key)).agg(F.collect_set(F.struct("runs", "items")).alias(parts))
    joined = held.join(durable(found), _text_key(F.col(text)) == F.col(key), "left").drop(key)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            texts = octets(batch.column(len(keep)))
            merged = map(_merged, batch.column(len(keep) + 1).to_pylist())
            found = [(len(item_words(t)), *m) for t, m in zip(texts, merged, strict=True)]
            yield _with_found(batch.select(range(len(keep))), texts, found, at, names)

    return map_batches(joined, apply, schema), names


def _text_key(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def remove_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the merged spans of benchmark windows in their texts; n_chars, if present, follows.

    A null text stays null. Exactly the columns of ``docs`` are returned, whatever their names.
    """
    out, (_, runs, _) = find_benchmark(docs, benchmark, docs.columns, cut=True)
    if "n_chars" in docs.columns:
        changed = F.when(F.size(runs) > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        out = out.withColumn("n_chars", changed.otherwise(F.col("n_chars")))
    return out.select(*own_columns(docs))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A report for each row of ``docs`` (doc_id, text)."""
    found, (words, runs, names) = find_benchmark(docs, benchmark, ["doc_id"])
    n_hit = F.aggregate(runs, F.lit(0).cast("bigint"), lambda s, r: s + r["b"] - r["a"])
    items = F.sort_array(F.array_distinct(names))
    return found.select(
        "doc_id",
        F.col(words).alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op2_decontaminate_fmindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Hit words by brute force over all window lengths that occur; windows are compared as lists of words.
OP2_SQL = r"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM items WHERE len(w) > 0)),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
places AS (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS (
  SELECT p.r, p.i, p.n, v.item_id
  FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM places) p JOIN windows v ON v.n = p.n AND v.win = p.win),
counts AS (
  SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS x FROM hits) GROUP BY r),
names AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(n.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(n.ids, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN counts c USING (r) LEFT JOIN names n USING (r)
"""
