"""Tables of mergeable sketches: distinct counts and quantiles of any span of days, from one row a day and key.

``append`` makes the sketches of the rows that have come in one pass and adds them to the table, so rows are read once; rows of a day that
was there before are one more entry of that day. ``merged`` merges entries on reading, by any of the keys, and ``trailing`` those of the days
up to each day. Sketches are binary columns, made before the shuffle in each task and merged behind it.

Bounds: a distinct count of 2 ** ``lg_k`` registers has a relative standard error of about 1.04 / 2 ** (``lg_k`` / 2), and merging
adds none; a quantile lies within a rank of about 2.3 / ``k`` ** 0.9 of the one asked for, in 99 of 100 cases. Counts of rows are exact.
Nulls count as rows only. A key without values has a count of 0 and null as its quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.names import col


def count_error(lg_k: int) -> float:
    """The relative standard error of a distinct count."""
    return 1.04 / 2 ** (lg_k / 2)


def rank_error(k: int) -> float:
    """The rank within which a quantile lies, in 99 of 100 cases."""
    return 2.3 / k**0.9


class SketchTable:
    """Sketches of ``distinct`` and ``values``, expressions by name, for each ``day`` and value of ``keys``, below ``root``."""

    def __init__(self, spark: SparkSession, root: str, day: Column, keys: Sequence[str], distinct: dict[str, Column], values: dict[str, Column], lg_k: int = 12, k: int = 800):
        self.spark, self.root, self.day, self.keys = spark, root.rstrip("/"), day, list(keys)
        self.distinct, self.values, self.lg_k, self.k = distinct, values, lg_k, k
        names = ["day", "n", *self.keys, *distinct, *values]
        if len({n.lower() for n in names}) < len(names):
            raise ValueError(f"names of a sketch table must differ: {names}")

    def append(self, rows: DataFrame) -> None:
        made = [F.hll_sketch_agg(c, self.lg_k).alias(n) for n, c in self.distinct.items()]
        made += [F.kll_sketch_agg_double(c.cast("double"), F.lit(self.k)).alias(n) for n, c in self.values.items()]
        rows.groupBy(self.day.cast("date").alias("day"), *map(col, self.keys)).agg(F.count("*").alias("n"), *made).write.mode("append").parquet(self.root)

    def entries(self) -> DataFrame:
        return self.spark.read.parquet(self.root)

    def _merged(self, entries: DataFrame, keys: Sequence[str]) -> DataFrame:
        both = [F.hll_union_agg(col(n)).alias(n) for n in self.distinct] + [F.kll_merge_agg_double(col(n), F.lit(self.k)).alias(n) for n in self.values]
        return entries.groupBy(*map(col, keys)).agg(F.sum("n").alias("n"), *both)

    def merged(self, keys: Sequence[str], first: Column | None = None, last: Column | None = None) -> DataFrame:
        """``keys``, n and one sketch a name, of the days from ``first`` to ``last``; which days are read is told by the scan."""
        entries = self.entries()
        if first is not None:
            entries = entries.filter(F.col("day") >= first)
        if last is not None:
            entries = entries.filter(F.col("day") <= last)
        return self._merged(entries, keys)

    def trailing(self, days: int, keys: Sequence[str] = ()) -> DataFrame:
        """As ``merged``, for each day with rows and the ``days`` - 1 before it. Merged days are sent on, not rows."""
        daily = self._merged(self.entries(), ["day", *keys])
        sent = daily.withColumn("day", F.explode(F.expr(f"transform(sequence(0, {days - 1}), i -> date_add(day, i))")))
        there = daily.select("day", *map(col, keys))
        null_safe = [F.col("a.day") == F.col("b.day"), *(F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys)]
        merged = self._merged(sent, ["day", *keys])
        return merged.alias("a").join(there.alias("b"), null_safe, "left_semi")

    def compact(self, root: str) -> SketchTable:
        """The table with one entry a day and key, written to ``root``."""
        self._merged(self.entries(), ["day", *self.keys]).write.parquet(root)
        return SketchTable(self.spark, root, self.day, self.keys, self.distinct, self.values, self.lg_k, self.k)

    def figures(self, merged: DataFrame, ranks: Sequence[float] = (0.5,)) -> DataFrame:
        """``merged`` with counts in place of the sketches of distinct values, and arrays of the quantiles at ``ranks`` in place of the others."""
        at = F.array(*(F.lit(float(r)) for r in ranks))
        counts = {n: F.hll_sketch_estimate(col(n)) for n in self.distinct}
        some = {n: F.when(F.kll_sketch_get_n_double(col(n)) > 0, F.kll_sketch_get_quantile_double(col(n), at)) for n in self.values}
        return merged.withColumns(counts | some)
