"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a run of consecutive words, for each template of ``reach`` words: its own number of words and a quarter more.
Line breaks don't end a block, so a notice may be wrapped. A template is found in a block if at least THRESHOLD of its
distinct words are among the block's, and with them the words that tell it from other templates ("mit", "mozilla").
Words are ordered by how many documents of the whole corpus hold them, rarest first. A block that holds a template must
hold one of the template's first words (prefix filter), have enough words (length filter) and, from the place where the
two orders meet, leave enough words on both sides (position filter). What passes is verified, so the join is exact. A
block that begins with a word that isn't the template's has no more of its words than the next one that does, so only
those are made. The base phrases are looked up as consecutive words.

Only the words of the templates take part in an overlap, so only they are counted, ordered and kept of a block.

Defined cases: a null text is empty and has no words; repeated rows each get their result; equal rows share one join;
a template without words is never found; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import bounded_batches, durable, item_words, octets, table

THRESHOLD = 0.8

#: Phrases that count wherever their words stand consecutively, and their labels.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
#: Opening sentences of public license notices, their labels, and the words that must be there.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit", "associated files"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd", "redistribution binary"),
    ("licensed under the apache license version 2.0 you may not use this file except in compliance with the license", "apache", "apache"),
    ("this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license", "gpl-notice", "gnu general public"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl", "mozilla"),
    ("this work is licensed under a creative commons attribution 4.0 international license", "cc-by-notice", "creative commons attribution"),
    ("permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted", "isc", "purpose fee"),
    ("this is free and unencumbered software released into the public domain", "unlicense", "unencumbered"),
    ("licensed under the apache license version 2.0", "apache", "apache"),
    ("released under the mit license", "mit", "mit"),
    ("licensed under the mit license", "mit", "mit"),
    ("licensed under the gnu general public license", "gpl", "gnu"),
    ("licensed under cc by 4.0", "cc-by", "cc"),
    ("licensed under the mozilla public license", "mpl", "mozilla"),
)


def word_sets(templates: tuple[tuple[str, ...], ...]) -> list[list[bytes]]:
    return [sorted(set(item_words(text.encode()))) for text, *_ in templates]


def reach(text: str) -> int:
    """The words of a template's blocks."""
    n = len(item_words(text.encode()))
    return n + n // 4 + 1


def document_counts(docs: DataFrame, words: set[bytes]) -> dict[bytes, int]:
    """How many rows of ``docs`` (text) hold each of ``words``: a bounded list, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in octets(batch.column(0)):
                counts.update(words.intersection(item_words(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["w", "n"])

    bounded_batches(docs.sparkSession)
    rows = docs.select("text").mapInArrow(run, "w binary, n bigint").groupBy("w").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["w"]): r["n"] for r in rows}


def needed(size: int, threshold: float) -> int:
    """How many of ``size`` words must be shared."""
    return math.ceil(size * threshold - 1e-9)


def prefix(words: list[bytes], order: dict[bytes, int], threshold: float) -> list[bytes]:
    """The words of which a block that meets the threshold holds one."""
    ranked = sorted(words, key=order.__getitem__)
    return ranked[: len(ranked) - needed(len(ranked), threshold) + 1] if ranked else []


def phrase_places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """Where ``phrase`` stands in ``words``."""
    found, at = [], -1
    try:
        while True:
            at = words.index(phrase[0], at + 1)
            if words[at : at + len(phrase)] == phrase:
                found.append(at)
    except ValueError:
        return found


def candidate_blocks(ranks: list[int], own: set[int], heads: set[int], names: set[int], size: int, least: int) -> set[tuple[int, ...]]:
    """The distinct blocks of ``size`` words that may hold the template with the words ``own``, each as its sorted ranks.

    Kept are those that begin with one of the words and hold ``least`` of them, one of ``heads`` and all ``names``.
    """
    places = [i for i, r in enumerate(ranks) if r in own]
    out: set[tuple[int, ...]] = set()
    held: Counter[int] = Counter()
    end = 0
    for k, at in enumerate(places):
        while end < len(places) and places[end] < at + size:
            held[ranks[places[end]]] += 1
            end += 1
        if len(held) >= least and not heads.isdisjoint(held) and names <= held.keys():
            out.add(tuple(sorted(held)))
        held[ranks[at]] -= 1
        if not held[ranks[at]]:
            del held[ranks[at]]
    return out


_SCANNED = "doc_id bigint, key bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, blocks array<array<int>>"
_SCANNED_TYPE = pa.schema([
    ("doc_id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())), ("blocks", pa.list_(pa.list_(pa.int32()))),
])


def scanned(docs: DataFrame, order: dict[bytes, int], threshold: float) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with the places of base phrases and its candidate blocks.

    A block is the number of the template that it is for, and the ordered ranks of that template's words in it.
    """
    phrases = [(text.encode().split(), label) for text, label in PHRASES]
    rarest = [min(words, key=lambda w: (order[w], w)) for words, _ in phrases]
    known = []
    for words, (text, _, named) in zip(word_sets(TEMPLATES), TEMPLATES, strict=True):
        ranks = {order[w] for w in words}
        heads = {order[w] for w in prefix(words, order, threshold)}
        known.append((ranks, heads, {order[w] for w in item_words(named.encode())}, reach(text), needed(len(ranks), threshold)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), octets(batch.column(1)), strict=True):
                words = item_words(text)
                ranks = [order.get(w, -1) for w in words]
                present = set(ranks)
                blocks: list[list[int]] = []
                for t, (own, heads, names, size, least) in enumerate(known):
                    if own and names <= present and not heads.isdisjoint(present) and len(own & present) >= least:
                        blocks += ([t, *b] for b in sorted(candidate_blocks(ranks, own, heads, names, size, least)))
                places: list[int] = []
                labels = []
                for (phrase, label), rare in zip(phrases, rarest, strict=True):
                    if order[rare] in present and (at := phrase_places(words, phrase)):
                        places += at
                        labels.append(label)
                key = xxhash.xxh64_intdigest(text or b"") - (1 << 63)
                first, last = (min(places), max(places)) if places else (None, None)
                rows.append((doc_id, key, len(words), len(places), first, last, sorted(set(labels)), blocks))
            yield pa.RecordBatch.from_pylist([dict(zip(_SCANNED_TYPE.names, r, strict=True)) for r in rows], schema=_SCANNED_TYPE)

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, _SCANNED)


def containment_join(blocks: DataFrame, templates: DataFrame, threshold: float) -> DataFrame:
    """(key columns of ``blocks``, template, overlap): every block that holds ``threshold`` of a template's tokens.

    Both sides have ``tokens``: distinct ranks in one global order, sorted. ``templates`` has also ``template``; blocks that
    have it, too, are each for one template.
    """
    keys = [c for c in blocks.columns if c not in ("tokens", "template")]
    # A little less than the product, so that an exact share isn't lost to rounding.
    least = F.ceil(F.size("t_tokens") * F.lit(threshold) - 1e-9).cast("int")
    t = templates.select("template", F.col("tokens").alias("t_tokens")).filter("size(tokens) > 0").withColumn("least", least)
    head = t.select("*", F.posexplode(F.slice("t_tokens", F.lit(1), F.size("t_tokens") - F.col("least") + 1)).alias("t_pos", "token"))
    probe = blocks.select("*", F.posexplode("tokens").alias("pos", "token"))
    rest = F.least(F.size("t_tokens") - F.col("t_pos"), F.size("tokens") - F.col("pos"))
    # Of the places where the orders meet only the first counts: there nothing before is shared.
    met = probe.join(head, ["token", *(c for c in blocks.columns if c == "template")]).filter(F.size("tokens") >= F.col("least"))
    meets = met.groupBy(*keys, "template").agg(
        F.min_by(F.struct("tokens", "t_tokens", "least", rest.alias("rest")), "pos").alias("m")
    ).filter("m.rest >= m.least")
    overlap = F.size(F.array_intersect("m.tokens", "m.t_tokens"))
    return meets.withColumn("overlap", overlap).filter("overlap >= m.least").select(*keys, "template", "overlap")


def license_report(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A report for each row of ``docs`` (doc_id, text): base phrases, labels, and the best share of any template found."""
    spark = docs.sparkSession
    sets = word_sets(TEMPLATES)
    words = {w for s in [*sets, *word_sets(PHRASES)] for w in s}
    counts = document_counts(docs, words)
    order = {w: i for i, w in enumerate(sorted(words, key=lambda w: (counts.get(w, 0), w)))}
    rows = durable(scanned(docs, order, threshold))
    known = [(i, label, len(s), sorted(order[w] for w in s)) for i, ((_, label, _), s) in enumerate(zip(TEMPLATES, sets, strict=True))]
    templates = spark.createDataFrame(known, "template int, label string, size int, tokens array<int>")
    some = rows.filter(F.size("blocks") > 0).dropDuplicates(["doc_id", "key"]).select("doc_id", "key", F.posexplode("blocks").alias("block", "b"))
    blocks = some.select("doc_id", "key", "block", F.col("b")[0].alias("template"), F.slice("b", F.lit(2), F.size("b") - 1).alias("tokens"))
    found = containment_join(blocks, templates, threshold).join(templates.drop("tokens"), "template")
    by_row = found.groupBy("doc_id", "key").agg(
        F.collect_set("label").alias("found"), F.max(F.col("overlap") / F.col("size")).alias("share")
    ).withColumnsRenamed({"doc_id": "_id", "key": "_key"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    both = F.array_union("base_labels", F.coalesce("found", F.array().cast("array<string>")))
    score = F.greatest(F.when(F.size("base_labels") > 0, 1.0).otherwise(0.0), F.coalesce("share", F.lit(0.0)))
    return rows.join(by_row, same, "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        score.alias("score"),
    )


def op6_licenses_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))


def _sql_list(words: list[bytes]) -> str:
    return "[" + ", ".join(f"'{w.decode()}'" for w in words) + "]"


_SQL_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SQL_PHRASES = ", ".join(f"({_sql_list(t.encode().split())}, '{label}')" for t, label in PHRASES)
_SQL_TEMPLATES = ", ".join(
    f"({i}, {_sql_list(s)}, '{label}', {needed(len(s), THRESHOLD)}, {_sql_list(item_words(named.encode()))}, {reach(text)})"
    for i, (s, (text, label, named)) in enumerate(zip(word_sets(TEMPLATES), TEMPLATES, strict=True))
)
#: Blocks are counted from every place of a template's word, in documents that hold enough of its words at all.
OP6_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, doc_id, {_SQL_WORDS.format("text")} AS w FROM docs),
phrases(p, label) AS (VALUES {_SQL_PHRASES}),
templates(t, own, label, least, names, reach) AS (VALUES {_SQL_TEMPLATES}),
places AS (
  SELECT r, label, i - 1 AS place FROM (SELECT r, w, p, label, unnest(range(1, len(w) - len(p) + 2)) AS i FROM words, phrases WHERE len(w) >= len(p) AND list_has_all(w, p))
  WHERE w[i:i + len(p) - 1] = p),
base AS (
  SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM places GROUP BY r),
likely AS (SELECT r, w, t, own, label, least, names, reach FROM words, templates WHERE list_has_all(w, names) AND len(list_intersect(w, own)) >= least),
hits AS (SELECT * FROM (SELECT * EXCLUDE (w), unnest(w) AS word, unnest(range(len(w))) AS i FROM likely) WHERE list_contains(own, word)),
blocks AS (
  SELECT a.r, a.t, a.i, any_value(a.label) AS label, count(DISTINCT b.word) / any_value(len(a.own)) AS share
  FROM hits a JOIN hits b ON a.r = b.r AND a.t = b.t AND b.i >= a.i AND b.i < a.i + a.reach
  GROUP BY a.r, a.t, a.i
  HAVING count(DISTINCT b.word) >= any_value(a.least) AND count(DISTINCT CASE WHEN list_contains(a.names, b.word) THEN b.word END) = any_value(len(a.names))),
marks AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM (
    SELECT r, label, share FROM blocks UNION ALL SELECT r, label, 1.0 FROM places) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM words LEFT JOIN base USING (r) LEFT JOIN marks USING (r)
"""
