"""Merged sketches against exact figures, within the stated bounds."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators.sketches import SketchTable, count_error, rank_error

RANKS = [0.1, 0.5, 0.9]


@pytest.fixture(scope="module")
def events(spark):
    rows = spark.range(60_000).select(
        F.date_add(F.lit("2024-01-01"), F.floor(F.col("id") / 3000).cast("int")).alias("at"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("kind"),
        F.pmod(F.hash("id"), F.lit(20_000)).alias("user"), F.when(F.col("id") % 10 > 0, F.pow(F.pmod(F.xxhash64("id"), F.lit(1000)), F.lit(2))).alias("value"),
        F.col("id"),
    )
    return rows.cache()


def store(spark, root):
    return SketchTable(spark, str(root), F.col("at"), ["kind"], {"users": F.col("user")}, {"value": F.col("value")})


def close(row, rows):
    users, values = {r["user"] for r in rows}, np.sort([r["value"] for r in rows if r["value"] is not None])
    assert row["n"] == len(rows) and abs(row["users"] - len(users)) <= 4 * count_error(12) * len(users)
    for rank, got in zip(RANKS, row["value"], strict=True):
        low, high = np.searchsorted(values, got, "left") / len(values), np.searchsorted(values, got, "right") / len(values)
        assert low - 2 * rank_error(800) <= rank <= high + 2 * rank_error(800)


def test_merged_days_are_like_one_pass(spark, events, tmp_path):
    table = store(spark, tmp_path / "a")
    for part in range(3):  # days arrive in parts
        table.append(events.filter(F.col("id") % 7 % 3 == part))
    rows = events.collect()
    assert table.entries().count() == 20 * 3 * 3
    whole = table.compact(str(tmp_path / "b"))
    assert whole.entries().count() == 20 * 3
    for one in (table, whole):
        for keys in ((), ("kind",)):
            got = one.figures(one.merged(keys), RANKS).collect()
            assert len(got) == (3 if keys else 1)
            for r in got:
                close(r, [x for x in rows if not keys or x["kind"] == r["kind"]])
    first, last = datetime.date(2024, 1, 4), datetime.date(2024, 1, 9)
    spans = whole.merged((), F.lit(first), F.lit(last))
    close(whole.figures(spans, RANKS).first(), [x for x in rows if first <= x["at"] <= last])
    for keys in ((), ("kind",)):
        got = table.figures(table.trailing(7, keys), RANKS).collect()
        assert len(got) == (60 if keys else 20)
        for r in got[::9]:
            near = [x for x in rows if r["day"] - datetime.timedelta(6) <= x["at"] <= r["day"]]
            close(r, [x for x in near if not keys or x["kind"] == r["kind"]])


def test_no_values_and_no_rows(spark, events, tmp_path):
    table = store(spark, tmp_path / "a")
    table.append(events.limit(0))
    assert table.figures(table.merged(["kind"])).count() == 0
    table.append(events.limit(5).select("at", "kind", F.lit(None).cast("int").alias("user"), F.lit(None).cast("double").alias("value")))
    assert [tuple(r) for r in table.figures(table.merged(())).collect()] == [(5, 0, None)]
    with pytest.raises(ValueError, match="must differ"):
        SketchTable(spark, "x", F.col("at"), ["day"], {}, {})
