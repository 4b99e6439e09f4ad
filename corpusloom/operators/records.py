"""Operators over records that have a key and a position: deduplication, upsert, order, pages, sequences.

None of them gathers a key's rows in one place where an aggregate does: first and last rows are minima and maxima, which
Spark computes in part before the shuffle, so a key of very many rows costs one row a task. Columns that they add for a while have
names that the rows don't have. Sequences by windows have a key in one task; where keys may be hot, take those in ``segments``.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.names import col, free, own


#: Pieces of a width that a range may touch before it stands in wider ones.
COARSER = 16
#: Rows, or ranges, of a piece that meet those of the other side together, at least and at most, and places to which all pairs are dealt.
CHUNK, MOST, PLACES = 4000, 100_000, 128
#: Ranges that a row meets at once.
PACK = 2000


def first_of_each(rows: DataFrame, key: Column, position: str) -> DataFrame:
    """The row of smallest ``position`` of each ``key``."""
    held, row = free(rows.columns, "_key", "_row")
    return rows.groupBy(key.alias(held)).agg(F.min_by(F.struct(*own(rows)), col(position)).alias(row)).select(f"{row}.*")


def new_only(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` isn't among those of ``known``."""
    return rows.join(known.select(key).distinct(), key, "left_anti")


def with_group(rows: DataFrame, key: Column, position: str) -> DataFrame:
    """``rows`` of keys that occur more than once, with group_first (smallest position) and group_size."""
    (held,) = free([*rows.columns, "group_first", "group_size"], "_key")
    keyed = rows.withColumn(held, key)
    groups = keyed.groupBy(held).agg(F.min(col(position)).alias("group_first"), F.count("*").alias("group_size")).filter("group_size > 1")
    return keyed.join(groups, held).drop(held)


def upsert(old: DataFrame, new: DataFrame, key: str, position: str, end: int | None = None) -> DataFrame:
    """The rows of ``new`` in place of all of ``old`` with their key; of several in ``new`` the last by ``position``.

    The replacement takes the place of the first row it replaces; keys that are new come after all the old ones, or after ``end``.
    """
    row, place = free([*old.columns, *new.columns], "_row", "_place")
    last = new.groupBy(key).agg(F.max_by(F.struct(*own(new)), col(position)).alias(row)).select(f"{row}.*")
    places = old.groupBy(key).agg(F.min(col(position)).alias(place))
    last_place = old.agg(F.max(col(position))).scalar() if end is None else F.lit(end)
    end = F.coalesce(last_place, F.lit(0)) + 1
    put = last.join(places, key, "left").withColumn(position, F.coalesce(col(place), end + col(position))).select(*own(old))
    return old.join(last.select(key), key, "left_anti").unionByName(put)


def delete_by_key(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` without those of the ``keys``; keys that aren't there are ignored."""
    return rows.join(keys.select(key).distinct(), key, "left_anti")


def by_key_order(rows: DataFrame, key: Column, position: str) -> DataFrame:
    """Sorted by ``key``; rows without one come last, ties by position."""
    return rows.orderBy(key.isNull(), key, position)


def numbered(rows: DataFrame, order: list[Column], name: str, folder: str) -> DataFrame:
    """``rows`` written to ``folder`` in ``order`` and read back with ``name``, their places from 1.

    Ranges are sorted apart and only their sizes are added up, one row a range, so no task holds all rows. The folder is
    one that all executors share; it also keeps the places if a range is lost later.
    """
    at, part, size, before, number = free([*rows.columns, name], "_at", "_range", "_size", "_before", "_number")
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.withColumn(at, F.monotonically_increasing_id()).write.parquet(folder)
    held = rows.sparkSession.read.parquet(folder).withColumn(part, F.shiftright(col(at), 33))
    sizes = held.groupBy(part).agg(F.count("*").alias(size))
    earlier = F.coalesce(F.sum(size).over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = col(at).bitwiseAND(F.lit((1 << 33) - 1))
    placed = held.join(sizes.select(part, earlier.alias(before)), part).withColumn(number, col(before) + within + 1)
    return placed.select(*(c for c, n in zip(own(rows), rows.columns, strict=True) if n.lower() != name.lower()), col(number).alias(name))


def page(rows: DataFrame, position: str, offset: int, limit: int, most: int = 500) -> DataFrame:
    """A page of the newest rows first; ``limit`` is held between 1 and ``most``."""
    return rows.orderBy(F.desc(position)).offset(max(0, offset)).limit(max(1, min(limit, most)))


def page_of_lines(lines: DataFrame, position: str, value: str, offset: int, limit: int, most: int = 500) -> DataFrame:
    """A page of JSON lines, newest first, with ``total``, the number of all lines that aren't blank.

    Only the page is parsed: lines that aren't JSON objects are dropped after it was cut, so it may be short.
    """
    full = lines.filter(~F.col(value).rlike(r"^\s*$"))
    total = full.agg(F.count("*")).scalar()
    object_ = F.schema_of_variant(F.try_parse_json(F.col(value))).startswith("OBJECT")
    return page(full, position, offset, limit, most).filter(F.coalesce(object_, F.lit(False))).withColumn("total", total)


def last_k(rows: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The last ``k`` rows of each key. Spark cuts each task's rows to k before the shuffle."""
    (place,) = free(rows.columns, "_place")
    return rows.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(col(place) <= k).drop(place)


def tail(rows: DataFrame, position: str, after: int | None, cold: int = 200) -> DataFrame:
    """The rows after position ``after``; at a cold start, with None, the last ``cold``."""
    if after is None:
        return rows.orderBy(F.desc(position)).limit(cold)
    return rows.filter(F.col(position) > after)


def sampled(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows without replacement: those of smallest seeded hash of ``key``, so reruns and other engines agree."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)


def origins(rows: DataFrame, position: str, initial: Column, consumed: Column) -> DataFrame:
    """``rows`` with origin (initial below the first count, else generated) and likely_consumed (below the second)."""
    origin = F.when(F.col(position) < initial, "initial").otherwise("generated")
    return rows.withColumn("origin", origin).withColumn("likely_consumed", F.col(position) < consumed)


def as_of(rows: DataFrame, events: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """``rows`` with ``value``: that of the last of ``events`` (keys, order, value) of the same keys at or before their ``order``.

    Both are put in one order and the last value is carried on: one shuffle by key, whatever the number of events. The rows
    of a key pass through one task in order, none of them held.
    """
    row, told, last = free([*rows.columns, *events.columns], "_row", "_told", "_last")
    both = rows.withColumn(row, F.lit(1)).unionByName(
        events.select(*keys, order, F.lit(0).alias(row), F.struct(col(value).alias("v")).alias(told)), allowMissingColumns=True
    )
    upto = Window.partitionBy(*keys).orderBy(order, row).rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn(last, F.last(told, ignorenulls=True).over(upto)).filter(col(row) == 1)
    return carried.select(*(c for c, n in zip(own(rows), rows.columns, strict=True) if n != value), col(last)["v"].alias(value))


def in_ranges(rows: DataFrame, ranges: DataFrame, at: str, begin: str, end: str, width: float) -> DataFrame:
    """Each of ``rows`` with each of ``ranges`` that holds it: begin <= at < end, all numbers.

    The line is cut to pieces of ``width``, a range stands in each piece that it touches, and rows meet it by piece, so it is
    an equi-join; a width near that of the ranges keeps both the copies and the misses few. A range of over COARSER pieces
    stands in pieces COARSER times as wide, or that again, so it never has more than COARSER + 1, however long it is; rows are
    dealt once for each of the widths that there are.

    Where a piece has many of both, each row of its is with each of its ranges, so the pairs are dealt out: the rows and the ranges
    of a piece are cut to chunks, and each chunk of rows meets each chunk of ranges in a place of its own. Chunks are as large as
    leaves about PLACES places, so a row or range is sent to a number of places that doesn't grow with the input, until a chunk
    has MOST of them. In a place ranges are gathered to packs of PACK by their begin, and all rows pass a pack in their order
    before they pass the next: files of the pairs hold the same ranges again and again, one close to the other, and so are small.
    """
    level, piece, row_chunk, range_chunk, row_chunks, range_chunks, n_rows, n_ranges, packs, pack, asked_pack, packed, low, high, turn = free(
        [*rows.columns, *ranges.columns], "_level", "_piece", "_row_chunk", "_range_chunk", "_row_chunks", "_range_chunks",
        "_n_rows", "_n_ranges", "_packs", "_pack", "_asked_pack", "_packed", "_low", "_high", "_turn",
    )
    place = lambda x: F.floor(x / (width * F.pow(F.lit(float(COARSER)), col(level)))).cast("bigint")
    span = F.greatest((col(end) - col(begin)) / width, F.lit(1.0))
    levels = F.greatest(F.ceil(F.ln(span) / math.log(COARSER)) - 1, F.lit(0)).cast("int")
    dealt = ranges.filter(col(begin) < col(end)).withColumn(level, levels)
    there = [r[0] for r in dealt.select(level).distinct().collect()]  # a width each: as many as a number has digits, at most
    dealt = dealt.withColumn(piece, F.explode(F.sequence(place(col(begin)), place(col(end)))))
    asked = rows.withColumn(level, F.explode(F.array(*map(F.lit, there)).cast("array<int>"))).withColumn(piece, place(col(at)))
    counted = lambda x, name: x.groupBy(level, piece).agg(F.count("*").cast("double").alias(name))
    sizes = counted(asked, n_rows).join(counted(dealt, n_ranges), [level, piece])
    pairs, most_rows, most_ranges = (x or 0 for x in sizes.agg(F.sum(col(n_rows) * col(n_ranges)), F.max(n_rows), F.max(n_ranges)).first())
    size = min(max(CHUNK, math.sqrt(pairs / PLACES)), MOST)
    held = (col(at) >= col(begin)) & (col(at) < col(end))
    if most_rows <= size and most_ranges <= PACK:
        return asked.join(dealt, [level, piece]).filter(held).drop(level, piece)

    of_size = lambda name: F.ceil(col(name) / size).cast("int")
    cuts = sizes.select(level, piece, of_size(n_rows).alias(row_chunks), of_size(n_ranges).alias(range_chunks), n_ranges)
    cuts = cuts.withColumn(packs, F.ceil(col(n_ranges) / col(range_chunks) / PACK).cast("int")).drop(n_ranges)
    hot = cuts.filter((col(row_chunks) > 1) | (col(range_chunks) > 1) | (col(packs) > 1))
    places = hot.agg(F.sum(col(row_chunks).cast("long") * col(range_chunks))).first()[0]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) + min(places, 10_000)
    keys = [level, piece, row_chunk, range_chunk]

    def cut(side: DataFrame, given: DataFrame, chunk: str, n: str, other: str, m: str) -> DataFrame:
        """Each row of ``side`` in its own chunk, once for each chunk of the other side, and with the number of packs there."""
        told = [col(f.name) for f in given.schema if not re.search(r"map<|variant", f.dataType.simpleString())]
        known = side.join(F.broadcast(hot), [level, piece], "left")  # a piece for each PACK rows or ranges at most
        own_chunk = F.pmod(F.xxhash64(*told), F.coalesce(col(n), F.lit(1)))
        others = F.explode(F.sequence(F.lit(0), F.coalesce(col(m), F.lit(1)) - 1))
        dealt_out = known.withColumn(chunk, own_chunk.cast("int")).withColumn(other, others).withColumn(packs, F.coalesce(col(packs), F.lit(1)))
        return dealt_out.drop(n, m).repartition(tasks, *map(col, keys))

    # What follows is done within a place: neither the rows for each pack nor the packs are sent anywhere.
    left = cut(asked, rows, row_chunk, row_chunks, range_chunk, range_chunks)
    left = left.withColumn(asked_pack, F.explode(F.sequence(F.lit(0), col(packs) - 1))).drop(packs)
    left = left.withColumn(turn, F.row_number().over(Window.partitionBy(*keys, asked_pack).orderBy(col(at))))
    right = cut(dealt, ranges, range_chunk, range_chunks, row_chunk, row_chunks)
    before = F.row_number().over(Window.partitionBy(*keys).orderBy(col(begin))) - 1
    gathered = F.collect_list(F.struct(*own(ranges))).alias(packed), F.min(col(begin)).alias(low), F.max(col(end)).alias(high)
    right = right.withColumn(pack, F.pmod(F.floor(before / PACK), col(packs))).groupBy(*keys, pack).agg(*gathered)
    # Were the pack a key of the join, both sides would be sent once more, by all keys.
    # Turns are asked for only as Spark drops a plain sort below a join.
    same = (F.abs(col(asked_pack) - col(pack)) < 1) & (col(turn) > 0) & (col(at) >= col(low)) & (col(at) < col(high))
    return left.join(right.hint("merge"), keys).filter(same).select(*own(rows), F.inline(packed)).filter(held)


def recent_same(rows: DataFrame, keys: list[str], order: str, value: str, k: int) -> DataFrame:
    """``rows`` with recent: the ``k`` values before this one of the same keys, oldest first."""
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(-k, -1)
    return rows.withColumn("recent", F.collect_list(value).over(before))


def latest_known(rows: DataFrame, keys: list[str], order: list[str], value: Column) -> DataFrame:
    """``rows`` with latest: the last ``value`` up to here that isn't null."""
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("latest", F.last(value, ignorenulls=True).over(upto))


def runs(rows: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """(keys, value, run_start, run_length) of consecutive rows with one value."""
    (island,) = free([*rows.columns, "run_start", "run_length"], "_island")
    by = Window.partitionBy(*keys).orderBy(order)
    number = F.row_number().over(by) - F.row_number().over(Window.partitionBy(*keys, value).orderBy(order))
    counted = rows.withColumn(island, number).groupBy(*keys, value, island)
    return counted.agg(F.min(order).alias("run_start"), F.count("*").alias("run_length")).drop(island)


def collapse_repeats(rows: DataFrame, keys: list[str], order: list[str], same: list[str]) -> DataFrame:
    """``rows`` without those whose next row agrees in ``same``: of a run the last stays, as an update would leave it."""
    following = Window.partitionBy(*keys).orderBy(*order)
    again = F.lit(True)
    for c in same:
        again = again & F.col(c).eqNullSafe(F.lead(c).over(following))
    last = F.lead(F.lit(1)).over(following).isNull()
    (mark,) = free(rows.columns, "_again")
    return rows.withColumn(mark, again & ~last).filter(~col(mark)).drop(mark)


def active(rows: DataFrame, key: str, order: list[str], done: Column) -> DataFrame:
    """The last row of each key whose last row isn't done."""
    (last,) = free(rows.columns, "_last")
    every = F.struct(F.struct(*own(rows)).alias("row"), done.alias("done"))
    lasts = rows.groupBy(key).agg(F.max_by(every, F.struct(*order)).alias(last))
    return lasts.filter(~col(last)["done"]).select(f"{last}.row.*")


def joined_text(rows: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
    """(keys, text) with the deltas of each key put together in order: one value, so one task has to hold a key's text."""
    parts = F.array_sort(F.collect_list(F.struct(order, text)))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda x: x[text]), "").alias("text"))


def most_of(*counts: Column) -> Column:
    """The largest of the counts that are there; 0 if none is."""
    return F.coalesce(F.greatest(*counts), F.lit(0))


def actual_turns(stated: Column, timeline: Column, turns: Column) -> Column:
    """The largest of the turns stated and those there; 0 if none are. Of rows, take ``most_of`` with a count in place of a list."""
    size = lambda a: F.when(a.isNotNull(), F.size(a))
    return most_of(stated, size(timeline), size(turns))


def last_elements(values: Column, k: int) -> Column:
    """The last ``k`` elements, or all."""
    n = F.least(F.size(values), F.lit(k))
    return F.when(n > 0, F.slice(values, F.size(values) - n + 1, n)).otherwise(values)


def percent_done(done: Column, total: Column) -> Column:
    """Whole percent, 100 at most, 0 of nothing."""
    return F.when(total > 0, F.least(F.lit(100), F.round(100 * done / total).cast("int"))).otherwise(0)


def range_errors(stated: dict[str, Column]) -> Column:
    """What is wrong with the turn limits of each row's configuration; a limit that is null or not stated is right."""
    limits = [k for k in ("min_turns", "max_turns", "target_turns") if k in stated]
    errors = [F.when(stated[k] <= 0, f"{k} must be above 0") for k in limits]
    if "min_turns" in stated and "max_turns" in stated:
        errors.append(F.when(stated["max_turns"] < stated["min_turns"], "max_turns is below min_turns"))
    return F.array_compact(F.array(*errors)) if errors else F.array().cast("array<string>")
