"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks.

The target of a source is its share of all words by weight, at most CAP times its own words; what lies above is
shared anew by weight (water filling). Equal-token blocks are allotted to the sources by highest quotients, and a
source's blocks to its shards likewise, which gives integer quotas. In a shard documents stand in a seeded order, their
words are cut into blocks, whole passes over the shard are taken first, and the rest of the quota is met by a seeded
permutation of the blocks. What whole blocks leave of a source's target, half a block or so, is asked of its largest
shard word by word, as a last part of a block; a source of a few words keeps its place in the mix. Only totals by source and
shard are gathered; documents stay in their shards, of about SHARD_WORDS words each, so a hot source has many.

Defined cases: a null text has size 0, and a size of 0 takes 0; a null source is a source of its own, the last in order;
repeated rows are documents of their own, ties in the seeded order fall to doc_id and size; an empty table gives no
rows; a corpus without words has targets 0; one of fewer words than a block is mixed word by word; columns of any names are
kept by ``mixed_documents``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import batches_of, bounded_batches, durable, free_names, map_batches, octets, own_columns, quoted, table

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A source gives at most so many times its own words.
CAP = 3
#: Words of a block.
BLOCK = 64
#: Words of a shard, about.
SHARD_WORDS = 1 << 18
SEED = 42
#: A prime above the number of blocks of any shard: multiples of it run through all remainders.
PRIME = 2147483647


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def seeded(*parts: Column) -> Column:
    """32 seeded bits of the parts, as bigint; the same in every engine that has md5."""
    joined = F.concat_ws(":", F.lit(str(SEED)), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("bigint")


def targets(sources: DataFrame) -> DataFrame:
    """(source, words) with weight and target. One row a source: a mix states a weight for each."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS))) + 1))
    weighed = sources.withColumn("weight", weight.cast("bigint")).withColumn("limit", F.col("words") * CAP)
    # Sources stop at their limit in order of limit / weight; the level is where those before leave enough for the rest.
    fill = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rest = F.sum("words").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    heavy = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levelled = weighed.withColumn("rest", rest).withColumn("heavy", heavy)
    fits = F.col("rest") * F.col("weight") <= F.col("limit") * F.col("heavy")
    level = F.min(F.when(fits, F.struct(F.col("limit") / F.col("weight"), "rest", "heavy"))).over(everything)
    shared = (F.col("weight") * level["rest"]).cast("double") / level["heavy"]
    target = F.least(F.col("limit").cast("double"), shared)
    return levelled.select("source", "words", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def places(rows: DataFrame, key: list[str], order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``name``: their places from 1 among the rows of their ``key``, by ``order``.

    Ranges of the whole order are sorted apart and what each holds of a key is added up, so no task holds all of a key.
    """
    ranged = rows.repartitionByRange(*key, *order).sortWithinPartitions(*key, *order)
    rows_at = durable(ranged.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id()))
    held = rows_at.groupBy("_part", *key).agg(F.count("*").alias("_n"), F.min("_at").alias("_from"))
    earlier = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    held = held.select("_from", "_before", F.col("_part").alias("_p"), *(F.col(c).alias(f"_{c}") for c in key))
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key), F.col("_part") == F.col("_p"))
    return rows_at.join(held, same).select(*rows.columns, (F.col("_before") + F.col("_at") - F.col("_from") + 1).alias(name))


def apportion(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """``rows`` (key, name: a number, share, unit, seats, any more) with quota: the seats by the highest quotients share / (2 k + 1).

    All rows of a key state the same seats and unit, its shares come to seats * unit; ties fall to the smaller ``name``.
    Rounding share / unit leaves at most half a seat a row to settle; those go by quotient. A row settles no more than
    share * (rows / 2 + 1) / (sum of shares) + 1 of them, as the divisor that gives out all seats is that near to the unit;
    so there are a few candidates a row, and no list of all seats. The result is that of handing out the seats one by one.
    """
    rows = durable(rows.withColumn("_first", F.floor(F.col("share") / F.col("unit") + 0.5)))
    sums = {"_given": F.sum("_first"), "_all": F.sum("share"), "_rows": F.count_if(F.col("share") > 0)}
    if key:
        totals = rows.groupBy(*(F.col(c).alias(f"_{c}") for c in key)).agg(*(v.alias(k) for k, v in sums.items()))
        same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key))
        summed = rows.join(totals, same).drop(*(f"_{c}" for c in key))
    else:
        summed = rows.withColumns({k: v.over(Window.partitionBy()) for k, v in sums.items()})
    summed = summed.withColumn("_lack", F.col("seats") - F.col("_given"))
    open_ = F.abs("_lack")
    most = F.floor(F.col("share") * (F.col("_rows") / 2 + 1) / F.greatest(F.col("_all"), F.lit(1e-9))) + 3
    again = summed.filter("_lack <> 0 AND share > 0").withColumn("_k", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(open_, most))))
    up = F.col("share") / (2 * (F.col("_first") + F.col("_k")) - 1)
    down = F.col("share") / (2 * (F.col("_first") - F.col("_k")) + 1)
    again = again.filter("_lack > 0 OR _first >= _k").select(
        *key, name, "_lack", F.when(F.col("_lack") > 0, -up).otherwise(down).alias("quotient"),
        F.when(F.col("_lack") > 0, F.col(name)).otherwise(-F.col(name)).alias("tie"),
    )
    order = [F.col("quotient"), F.col("tie")]
    if key:
        placed = places(again, key, order, "_row")
    else:
        placed = again.withColumn("_row", F.row_number().over(Window.orderBy(*order)))
    won = placed.filter(F.col("_row") <= open_).groupBy(*(F.col(c).alias(f"_{c}") for c in (*key, name)))
    won = won.agg(F.sum(F.signum("_lack")).cast("bigint").alias("_won"))
    joined = rows.join(won, reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*key, name))), "left")
    quota = (F.col("_first") + F.coalesce("_won", F.lit(0))).cast("bigint")
    return joined.select(*(c for c in rows.columns if c[0] != "_"), quota.alias("quota"))


def _rank(block: Column) -> Column:
    """The place of a block of its shard in the seeded order."""
    return F.pmod(block * PRIME + F.col("start"), F.greatest(F.col("blocks"), F.lit(1)))


def mix(sizes: DataFrame) -> DataFrame:
    """``sizes`` (doc_id, source, size, any more) with source_size, target, taken, passes and picked.

    passes: whole times the document is taken; picked: the runs of its words [a, b) that are taken once more.
    """
    sizes = durable(sizes)
    # Few rows, one a source: the mix is stated by source.
    number = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))).cast("bigint")
    sources = durable(targets(sizes.groupBy("source").agg(F.sum("size").alias("words"))).withColumn("number", number))
    seats = F.round(F.sum("words").over(Window.partitionBy()) / BLOCK).cast("bigint")
    sources = apportion(sources.withColumns({"share": F.col("target"), "unit": F.lit(float(BLOCK)), "seats": seats}), [], "number")
    sources = durable(sources.select(
        "source", F.col("words").alias("source_size"), "target", F.col("quota").alias("source_quota"),
        (F.round("target").cast("bigint") - F.col("quota") * BLOCK).alias("rest"),
        F.ceil(F.greatest(F.col("words"), F.lit(1)) / SHARD_WORDS).cast("bigint").alias("shards"),
    ))
    src = sources.withColumnRenamed("source", "_source")
    # Sources are few, but nothing bounds them: Spark broadcasts this side only below its own threshold.
    docs = sizes.join(src, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    docs = docs.withColumn("shard", F.pmod(seeded(F.lit("shard"), F.col("doc_id"), F.col("size")), F.col("shards")))
    shards = docs.groupBy("source", "shard").agg(
        F.sum("size").alias("words"), *(F.first(c).alias(c) for c in ("source_size", "source_quota", "rest"))
    )
    unit = F.greatest(F.col("source_size"), F.lit(1)) / F.greatest(F.col("source_quota"), F.lit(1)).cast("double")
    share = F.when(F.col("source_quota") > 0, F.col("words").cast("double")).otherwise(F.lit(0.0))
    quotas = durable(apportion(shards.withColumns({"share": share, "unit": unit, "seats": F.col("source_quota")}), ["source"], "shard"))
    # What a source's blocks leave of its target is asked of its largest shard, so that sources of a few words keep theirs.
    largest = F.max(F.struct("words", (-F.col("shard")).alias("shard"))).alias("largest")
    largest = quotas.groupBy(F.col("source").alias("_source")).agg(largest).select("_source", (-F.col("largest.shard")).alias("_largest"))
    quotas = quotas.join(largest, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    more = F.when(F.col("shard") == F.col("_largest"), F.col("rest")).otherwise(0)
    asked = F.greatest(F.col("quota") * BLOCK + more, F.lit(0)).cast("bigint")
    passes = F.when(F.col("words") > 0, F.least(F.lit(CAP), F.floor(F.col("asked") / F.col("words")))).otherwise(0).cast("bigint")
    quotas = quotas.withColumn("asked", asked).withColumn("passes", passes).withColumns({
        "left": F.when(F.col("passes") < CAP, F.col("asked") - F.col("passes") * F.col("words")).otherwise(0),
        "blocks": F.ceil(F.col("words") / BLOCK).cast("bigint"),
        "start": seeded(F.lit("start"), F.col("source"), F.col("shard")),
    })
    # The last block of a shard may be short: what is left is counted in the seeded order, where it stands somewhere.
    quotas = quotas.withColumn("short", _rank(F.greatest(F.col("blocks") - 1, F.lit(0))) * BLOCK).withColumn("length", F.col("words") - (F.col("blocks") - 1) * BLOCK)
    before, within = F.col("left") <= F.col("short"), F.col("left") < F.col("short") + F.col("length")
    full = F.when(before, F.col("left")).otherwise(F.col("left") + BLOCK - F.col("length"))
    inside = ~before & within
    quotas = durable(quotas.select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), "passes", "blocks", "start",
        F.when(inside, F.col("short") / BLOCK).otherwise(F.floor(full / BLOCK)).cast("bigint").alias("more"),
        F.when(inside, F.col("left") - F.col("short")).otherwise(F.pmod(full, F.lit(BLOCK))).cast("bigint").alias("partial"),
    ))
    docs = docs.join(quotas, F.col("source").eqNullSafe(F.col("_source")) & F.col("shard").eqNullSafe(F.col("_shard")), "left")
    place = Window.partitionBy("source", "shard").orderBy(seeded(F.lit("order"), F.col("doc_id")), "doc_id", "size")
    docs = docs.withColumn("_end", F.sum("size").over(place.rowsBetween(Window.unboundedPreceding, 0)))
    docs = docs.withColumn("_begin", F.col("_end") - F.col("size"))
    first, last = F.floor(F.col("_begin") / BLOCK), F.floor((F.col("_end") - 1) / BLOCK)
    touched = F.when(F.col("size") > 0, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    chosen = F.filter(touched, lambda i: _rank(i) <= F.col("more"))
    length = lambda i: F.when(_rank(i) < F.col("more"), F.lit(BLOCK).cast("bigint")).otherwise(F.col("partial"))
    runs = F.transform(
        chosen,
        lambda i: F.struct(
            F.greatest(i * BLOCK - F.col("_begin"), F.lit(0).cast("bigint")).alias("a"),
            F.least(i * BLOCK + length(i) - F.col("_begin"), F.col("size")).alias("b"),
        ),
    )
    docs = docs.withColumn("picked", F.filter(runs, lambda r: r["a"] < r["b"]))
    extra = F.aggregate("picked", F.lit(0).cast("bigint"), lambda s, r: s + r["b"] - r["a"])
    return docs.withColumn("taken", F.col("passes") * F.col("size") + extra).select(
        *sizes.columns, "source_size", "target", "taken", "passes", "picked"
    )


def op4_mix_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mix(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def cut_blocks(text: bytes, picked: list[dict[str, int]]) -> bytes:
    """The words of the picked runs, with what stands between them inside a run; runs that touch are one."""
    spans = [m.span() for m in _WORD.finditer(text)]
    runs: list[list[int]] = []
    for r in sorted((r["a"], r["b"]) for r in picked):
        if runs and runs[-1][1] == r[0]:
            runs[-1][1] = r[1]
        else:
            runs.append(list(r))
    return b"\n".join(text[spans[a][0] : spans[b - 1][1]] for a, b in runs)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: a row for every whole pass over a document and one for the blocks taken once more.

    Exactly the columns of ``docs`` are returned; n_chars, if present, follows the text. A document without words takes
    nothing, so it has no row. Texts are read once for their sizes and once for the rows; between the two only ids and sizes
    are shuffled. Rows of equal doc_id and text are numbered by what their other columns hold, so that each meets one plan, the same in each run.
    """
    key, number, passes, picked, whole = free_names(docs.columns, "_key", "_number", "_passes", "_picked", "_whole")
    row_key = F.xxhash64("doc_id", "text")
    plan = mix(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), row_key.alias("key"))).filter("taken > 0")
    plan = durable(plan.select(F.col("doc_id").alias("_plan_id"), F.col("key").alias("_plan_key"), F.col("passes").alias(passes), F.col("picked").alias(picked)))
    keyed = docs.withColumn(key, row_key)
    id_, plan_id, plan_key = docs["doc_id"], plan["_plan_id"], plan["_plan_key"]
    if plan.groupBy("_plan_id", "_plan_key").count().filter("count > 1").isEmpty():
        joined = keyed.join(plan, id_.eqNullSafe(plan_id) & (F.col(key) == plan_key))
    else:
        others = [F.col(quoted(c)) for c in docs.columns if c not in ("doc_id", "text")]
        rest = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0)
        keyed = keyed.withColumn(number, F.row_number().over(Window.partitionBy("doc_id", quoted(key)).orderBy(rest)))
        order = Window.partitionBy("_plan_id", "_plan_key").orderBy(quoted(passes), quoted(picked))
        plan = plan.withColumn("_plan_number", F.row_number().over(order))
        same = keyed["doc_id"].eqNullSafe(plan["_plan_id"]) & (keyed[quoted(key)] == plan["_plan_key"])
        joined = keyed.join(plan, same & (keyed[quoted(number)] == plan["_plan_number"]))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            n = batch.num_columns - 2
            rows, texts, marks = [], [], []
            every = zip(octets(batch.column(at)), batch.column(n).to_pylist(), batch.column(n + 1).to_pylist(), strict=True)
            for k, (text, times, runs) in enumerate(every):
                part = [cut_blocks(text, runs)] if runs else []
                rows += [k] * (times + len(part))
                texts += [text] * times + part
                marks += [True] * times + [False] * len(part)
            taken = batch.select(range(n)).take(pa.array(rows, pa.int64()))
            columns = [*taken.columns, pa.array(marks, pa.bool_())]
            columns[at] = pa.array(texts, pa.binary()).cast(batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=[*taken.schema.names, whole])

    bounded_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField(whole, T.BooleanType())])
    rows = map_batches(joined.select(*own_columns(docs), F.col(passes), F.col(picked)), run, schema)
    if "n_chars" in docs.columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(F.col(whole), F.col("n_chars")).otherwise(changed))
    return rows.select(*own_columns(docs))


_ORDERED = "source IS NULL, encode(source)"
_BITS = "CAST('0x' || substr(md5('42:' || {}), 1, 8) AS BIGINT)"
#: The same mix; seats are handed out from a list of every quotient that could win one.
OP4_SQL = f"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
s1 AS (
  SELECT source, sum(size)::BIGINT AS words, [5, 2, 1][((row_number() OVER (ORDER BY {_ORDERED}) - 1) % 3 + 1)::INT]::BIGINT AS weight
  FROM sizes GROUP BY source),
s2 AS (
  SELECT *, 3 * words AS lim,
    sum(words) OVER () - coalesce(sum(3 * words) OVER w, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS heavy
  FROM s1 WINDOW w AS (ORDER BY (3 * words) / weight, {_ORDERED} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT rest, heavy FROM s2 WHERE rest * weight <= lim * heavy ORDER BY lim / weight, rest, heavy LIMIT 1),
s3 AS (
  SELECT source, words, least(lim::DOUBLE, (weight * l.rest)::DOUBLE / l.heavy) AS target, round(sum(words) OVER () / 64)::BIGINT AS seats
  FROM s2, level l),
won AS (
  SELECT source, count(*) AS quota FROM (
    SELECT source, seats, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source) AS n
    FROM (SELECT source, target, seats, unnest(range(CAST(target / 64 + 3 AS BIGINT))) AS k FROM s3)) WHERE n <= seats GROUP BY source),
s4 AS (
  SELECT s3.source, words AS source_size, target, coalesce(quota, 0) AS source_quota, ceil(greatest(words, 1) / 262144)::BIGINT AS shards,
    round(target)::BIGINT - coalesce(quota, 0) * 64 AS rest
  FROM s3 LEFT JOIN won ON s3.source IS NOT DISTINCT FROM won.source),
d1 AS (
  SELECT z.*, s.source_size, s.target, s.source_quota, s.rest, {_BITS.format("'shard:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || size")} % s.shards AS shard
  FROM sizes z JOIN s4 s ON z.source IS NOT DISTINCT FROM s.source),
h1 AS (
  SELECT source, shard, sum(size)::BIGINT AS words, any_value(source_quota) AS seats, any_value(source_size) AS total, any_value(rest) AS rest
  FROM d1 GROUP BY source, shard),
h2 AS (
  SELECT source, shard, count(*) AS quota FROM (
    SELECT source, shard, seats, row_number() OVER (PARTITION BY source ORDER BY words / (2 * k + 1) DESC, shard) AS n
    FROM (SELECT source, shard, words, seats, unnest(range(CAST(words * seats / greatest(total, 1) + 3 AS BIGINT))) AS k FROM h1)) WHERE n <= seats
  GROUP BY source, shard),
h3 AS (
  SELECT h1.source, h1.shard, words, greatest(0, coalesce(quota, 0) * 64 +
    CASE WHEN row_number() OVER (PARTITION BY h1.source ORDER BY words DESC, h1.shard) = 1 THEN rest ELSE 0 END)::BIGINT AS asked
  FROM h1 LEFT JOIN h2 ON h1.source IS NOT DISTINCT FROM h2.source AND h1.shard = h2.shard),
h4 AS (
  SELECT *, CASE WHEN words > 0 THEN least(3, asked // words) ELSE 0 END AS passes, ceil(words / 64)::BIGINT AS blocks,
    {_BITS.format("'start:' || coalesce(source, '') || ':' || shard")} AS start
  FROM h3),
h5 AS (
  SELECT *, CASE WHEN passes < 3 THEN asked - passes * words ELSE 0 END AS remains, words - (blocks - 1) * 64 AS length,
    ((greatest(blocks - 1, 0) * 2147483647 + start) % greatest(blocks, 1)) * 64 AS short
  FROM h4),
h6 AS (
  SELECT *, CASE WHEN remains <= short THEN remains // 64 WHEN remains < short + length THEN short // 64 ELSE (remains + 64 - length) // 64 END AS more,
    CASE WHEN remains <= short THEN remains % 64 WHEN remains < short + length THEN remains - short ELSE (remains + 64 - length) % 64 END AS part
  FROM h5),
d2 AS (
  SELECT d1.*, h6.passes, h6.more, h6.part, h6.blocks, h6.start, sum(size) OVER w AS e, sum(size) OVER w - size AS b
  FROM d1 JOIN h6 ON d1.source IS NOT DISTINCT FROM h6.source AND d1.shard = h6.shard
  WINDOW w AS (PARTITION BY d1.source, d1.shard ORDER BY {_BITS.format("'order:' || coalesce(CAST(doc_id AS VARCHAR), '')")}, doc_id NULLS FIRST, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT doc_id, size, source_size, target, (passes * size + CASE WHEN size = 0 THEN 0 ELSE coalesce(list_sum(list_transform(
    list_filter(range((b // 64)::BIGINT, ((e - 1) // 64 + 1)::BIGINT), lambda i: (i * 2147483647 + start) % blocks <= more),
    lambda i: greatest(0, least(i * 64 + CASE WHEN (i * 2147483647 + start) % blocks < more THEN 64 ELSE part END - b, size) - greatest(i * 64 - b, 0)))), 0) END)::BIGINT AS taken
FROM d2
"""
