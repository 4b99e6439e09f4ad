"""Segmented scans against the windows by key, over many ranges, with a key of a third of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import records, segments

ROWS = "k string, t long, v string, _segment int, _carry string, _last long"


@pytest.fixture
def ranges(spark):
    """Ranges stay as many as there are, however small."""
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    yield spark
    for c, v in old.items():
        spark.conf.set(c, v)


def table(spark, seed, n=900):
    draw = random.Random(seed)
    rows, last = [], "a"
    for t in range(n):
        last = draw.choice((last, last, last, "a", "b", None))  # long runs, some over several ranges
        rows.append((draw.choice(("hot", "hot", "x", "y", None, f"k{draw.randrange(40)}")), t, last if draw.random() < 0.8 or seed % 2 else None, 7, "c", t))
    rows += [("long", n + t, "same", 7, "c", t) for t in range(300)]  # one run over many ranges
    return spark.createDataFrame(rows, ROWS).repartition(5)


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    got, want = (sorted(map(str, map(tuple, x.select(*sorted(b.columns)).collect()))) for x in (a, b))
    assert got == want


@pytest.mark.parametrize("seed", [1, 2])
def test_results_are_those_of_the_windows(ranges, tmp_path, seed):
    rows = table(ranges, seed)
    value = F.when(F.col("t") % 7 == 0, F.col("v"))
    same(segments.latest_known(rows, ["k"], ["t"], value, "latest", f"{tmp_path}/1"), records.latest_known(rows, ["k"], ["t"], value))
    for k in (1, 3, 400):
        same(segments.recent_same(rows, ["k"], ["t"], "v", k, f"{tmp_path}/2-{k}"), records.recent_same(rows, ["k"], "t", "v", k))
    same(segments.runs(rows, ["k"], "t", "v", f"{tmp_path}/3"), records.runs(rows, ["k"], "t", "v"))
    same(segments.collapse_repeats(rows, ["k"], ["t"], ["v"], f"{tmp_path}/4"), records.collapse_repeats(rows, ["k"], ["t"], ["v"]))
    events = rows.filter("t % 11 = 3").select("k", "t", F.when(F.col("t") % 2 == 0, F.col("v")).alias("seen"))
    same(segments.as_of(rows, events, ["k"], "t", "seen", f"{tmp_path}/5"), records.as_of(rows, events, ["k"], "t", "seen"))


def test_a_hot_key_lies_in_its_share_of_the_ranges(ranges, tmp_path):
    rows = ranges.range(12_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("t"))
    s = segments.segments(rows, ["k"], ["t"], f"{tmp_path}/one")
    per = {r[0]: r[1] for r in s.rows.groupBy(s.range).count().collect()}
    hot = {r[0]: r[1] for r in s.rows.filter("k = 'hot'").groupBy(s.range).count().collect()}
    assert len(per) == 12 and len(hot) >= 4 and max(per.values()) < 2 * 12_000 / 12
    carry = s.summed(s.rows, n=F.count("*"))
    assert carry.count() <= 2 * 12 and {r["k"] for r in carry.collect()} == {"hot"}
    joined = segments.latest_known(rows, ["k"], ["t"], F.col("t"), "latest", f"{tmp_path}/more")
    assert joined.filter("latest <> t OR latest IS NULL").count() == 0


def test_empty_and_single(ranges, tmp_path):
    rows = table(ranges, 1)
    for i, few in enumerate((rows.limit(0), rows.filter("t = 5"))):
        assert segments.latest_known(few, ["k"], ["t"], F.col("v"), "latest", f"{tmp_path}/a{i}").count() == few.count()
        assert segments.runs(few, ["k"], "t", "v", f"{tmp_path}/b{i}").count() == few.count()
        assert segments.collapse_repeats(few, ["k"], ["t"], ["v"], f"{tmp_path}/c{i}").count() == few.count()
        assert segments.recent_same(few, ["k"], ["t"], "v", 2, f"{tmp_path}/d{i}").count() == few.count()
