"""Sequences of keys that may be hot: a segmented scan in place of a window by key.

A window by key alone has all rows of a key in one task. Here rows are dealt to ranges of (key, order), so a key with a third of all
rows lies in a third of the ranges, and each range is scanned alone. What a scan has to know of the ranges before it, or
after it, is put together from one row for each range and key, and only keys that lie in several ranges, two a range, have any:
the carry, which is joined to the rows of its range. The results are those of the windows in ``records``.

Rows of one key and equal ``order`` lie in one range, and their order among themselves isn't fixed, as in a window.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from corpusloom.operators.names import col, free, own


@dataclass
class Segments:
    """``rows`` (of ``columns``) with the number of their range, in order of ``keys`` and ``order``."""

    rows: DataFrame
    columns: list[str]
    keys: list[str]
    order: list[str]
    range: str

    @property
    def within(self) -> WindowSpec:
        """The rows of a key in a range."""
        return Window.partitionBy(col(self.range), *map(col, self.keys)).orderBy(*map(col, self.order))

    @property
    def upto(self) -> WindowSpec:
        return self.within.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    @property
    def across(self) -> WindowSpec:
        """The ranges of a key, one row each."""
        return Window.partitionBy(*map(col, self.keys)).orderBy(col(self.range))

    @property
    def before(self) -> WindowSpec:
        return self.across.rowsBetween(Window.unboundedPreceding, -1)

    def at(self) -> Column:
        """A row's place in its key, to be compared."""
        return F.struct(*map(col, self.order))

    def summed(self, rows: DataFrame, **sums: Column) -> DataFrame:
        """One row for each range and key, of the keys that lie in several ranges. Sums are made before the shuffle."""
        (many,) = free([*self.columns, self.range, *sums], "_ranges")
        each = rows.groupBy(col(self.range), *map(col, self.keys)).agg(*(v.alias(k) for k, v in sums.items()))
        counted = each.withColumn(many, F.count("*").over(Window.partitionBy(*map(col, self.keys))))
        return counted.filter(col(many) > 1).drop(many)

    def carried(self, rows: DataFrame, carry: DataFrame, *values: str) -> DataFrame:
        """``rows`` with the ``values`` of the ``carry`` of their range and key; null without one."""
        both = [self.range, *self.keys]
        names = free([*rows.columns, *values], *(f"_{i}" for i in range(len(both))))
        known = carry.select(*(col(c).alias(n) for c, n in zip(both, names, strict=True)), *map(col, values))
        same = reduce(and_, (col(c).eqNullSafe(col(n)) for c, n in zip(both, names, strict=True)))
        return rows.join(known, same, "left").drop(*names)


def segments(rows: DataFrame, keys: list[str], order: list[str], folder: str) -> Segments:
    """``rows`` dealt to ranges and written to ``folder``, one that all executors share, so that a range that is lost is the same again."""
    at, number = free(rows.columns, "_at", "_segment")
    ranged = rows.repartitionByRange(*map(col, keys), *map(col, order))
    ranged.withColumn(at, F.spark_partition_id()).write.parquet(folder)
    held = rows.sparkSession.read.parquet(folder).withColumnRenamed(at, number)
    return Segments(held, rows.columns, keys, order, number)


def latest_known(rows: DataFrame, keys: list[str], order: list[str], value: Column, name: str, folder: str) -> DataFrame:
    """``rows`` with ``name``: the last ``value`` of their key up to here that isn't null."""
    told, carry = free([*rows.columns, name], "_told", "_carry")
    s = segments(rows.withColumn(told, F.when(value.isNotNull(), F.struct(value.alias("v")))), keys, order, folder)
    last = s.summed(s.rows, **{carry: F.max_by(col(told), F.when(col(told).isNotNull(), s.at()))})
    last = last.withColumn(carry, F.last(col(carry), ignorenulls=True).over(s.before))
    joined = s.carried(s.rows.withColumn(told, F.last(col(told), ignorenulls=True).over(s.upto)), last, carry)
    return joined.select(*(c for c, n in zip(own(rows), rows.columns, strict=True) if n.lower() != name.lower()), F.coalesce(col(told), col(carry))["v"].alias(name))


def as_of(rows: DataFrame, events: DataFrame, keys: list[str], order: str, value: str, folder: str) -> DataFrame:
    """``rows`` with ``value``: that of the last of ``events`` (keys, order, value) of their keys at or before their ``order``."""
    asks, told = free([*rows.columns, *events.columns], "_asks", "_told")
    both = rows.withColumn(asks, F.lit(1)).unionByName(
        events.select(*map(col, keys), col(order), F.lit(0).alias(asks), F.struct(col(value).alias("v")).alias(told)), allowMissingColumns=True
    )
    (name,) = free(both.columns, "_last")
    found = latest_known(both, keys, [order, asks], col(told), name, folder).filter(col(asks) == 1)
    return found.select(*(c for c, n in zip(own(rows), rows.columns, strict=True) if n != value), col(name)["v"].alias(value))


def recent_same(rows: DataFrame, keys: list[str], order: list[str], value: str, k: int, folder: str) -> DataFrame:
    """``rows`` with recent: the values of the ``k`` rows before this one of its keys, oldest first, without nulls."""
    s = segments(rows, keys, order, folder)
    held, carry, place = free([*s.rows.columns, "recent"], "_held", "_carry", "_place")
    kept = F.struct(col(value).alias("v"))
    back = Window.partitionBy(col(s.range), *map(col, keys)).orderBy(*(col(c).desc() for c in order))
    last = s.rows.withColumn(place, F.row_number().over(back)).filter(col(place) <= k)
    tail = F.array_sort(F.collect_list(F.struct((-col(place)).alias("p"), col(value).alias("v"))))
    ends = s.summed(last, **{carry: F.transform(tail, lambda x: F.struct(x["v"].alias("v")))})
    # The k ranges before have k rows or more, or they are all.
    ends = ends.withColumn(carry, F.flatten(F.collect_list(col(carry)).over(s.across.rowsBetween(-k, -1))))
    here = s.rows.withColumn(held, F.collect_list(kept).over(s.within.rowsBetween(-k, -1)))
    joined = s.carried(here, ends, carry)
    every = F.concat(F.coalesce(col(carry), F.array().cast(here.schema[held].dataType)), col(held))
    every = F.slice(every, F.greatest(F.size(every) - k + 1, F.lit(1)), k)
    return joined.select(*own(rows), F.transform(F.filter(every, lambda x: x["v"].isNotNull()), lambda x: x["v"]).alias("recent"))


def runs(rows: DataFrame, keys: list[str], order: str, value: str, folder: str) -> DataFrame:
    """(keys, value, run_start, run_length) of consecutive rows with one value.

    A range's first run may have begun in a range before: at the last start there, if the ranges between hold nothing else.
    """
    s = segments(rows.select(*map(col, keys), col(order), col(value)), keys, [order], folder)
    begin, first, start, lead, same, head, tail = free([*s.rows.columns, "run_start", "run_length"], "_begin", "_first", "_start", "_lead", "_same", "_head", "_tail")
    v = F.struct(col(value).alias("v"))
    before = F.lag(v).over(s.within)
    here = s.rows.withColumn(begin, F.when(before.isNull() | ~before.eqNullSafe(v), col(order)))
    here = here.withColumn(start, F.last(col(begin), ignorenulls=True).over(s.upto)).withColumn(first, F.min(col(order)).over(s.upto))
    ends = s.summed(here, **{head: F.min_by(v, col(order)), tail: F.max_by(v, col(order)), first: F.min(col(order)), start: F.max(col(begin))})
    ends = ends.withColumn(same, F.coalesce(F.lag(col(tail)).over(s.across).eqNullSafe(col(head)) & F.lag(col(first)).over(s.across).isNotNull(), F.lit(False)))
    anchor = F.when(~col(same) | (col(start) > col(first)), col(start))
    ends = ends.withColumn(lead, F.when(col(same), F.last(anchor, ignorenulls=True).over(s.before)))
    joined = s.carried(here, ends.select(col(s.range), *map(col, keys), col(lead)), lead)
    begun = F.when((col(start) == col(first)) & col(lead).isNotNull(), col(lead)).otherwise(col(start))
    counted = joined.groupBy(*map(col, keys), col(value), begun.alias("run_start")).agg(F.count("*").alias("run_length"))
    return counted.select(*map(col, keys), col(value), "run_start", "run_length")


def collapse_repeats(rows: DataFrame, keys: list[str], order: list[str], same: list[str], folder: str) -> DataFrame:
    """``rows`` without those whose next row of the key agrees in ``same``: of a run the last stays."""
    s = segments(rows, keys, order, folder)
    follow, carry = free(s.rows.columns, "_follow", "_carry")
    told = F.struct(*map(col, same))
    firsts = s.summed(s.rows, **{carry: F.min_by(told, s.at())})
    firsts = firsts.withColumn(carry, F.lead(col(carry)).over(s.across))
    joined = s.carried(s.rows.withColumn(follow, F.lead(told).over(s.within)), firsts, carry)
    return joined.filter(~F.coalesce(col(follow), col(carry)).eqNullSafe(told)).select(*own(rows))
