"""Columns named like those that operators add for a while, long ranges, and repairs that would change a text."""

import random

import pytest

from corpusloom.functions import jsontext
from corpusloom.operators import records
from pyspark.sql import functions as F

ODD = ["_key", "_row", "_place", "_at", "_range", "_size", "_before", "_told", "_last", "_piece", "_level", "_island", "_again", "_number"]


def test_records_keep_columns_of_any_names(spark, tmp_path):
    names = ["k", "p", "v", *ODD]
    draw = random.Random(1)
    data = [(draw.randrange(4), i, draw.choice("ab"), *(f"{c}{i}" for c in ODD)) for i in range(30)]
    rows = spark.createDataFrame(data, names)
    by_place = {r[1]: r for r in data}
    kept = lambda got: all(tuple(r[c] for c in names) == by_place[r["p"]] for r in got.collect())
    for got, n in (
        (records.first_of_each(rows, F.col("k"), "p"), 4),
        (records.with_group(rows, F.col("k"), "p"), 30),
        (records.upsert(rows, rows.limit(0), "k", "p"), 30),
        (records.upsert(rows.limit(0), rows.filter("p < 9"), "p", "p").withColumn("p", F.col("p") - 1), 9),
        (records.numbered(rows, [F.col("p")], "place", f"{tmp_path}/n"), 30),
        (records.last_k(rows, ["k"], [F.desc("p")], 2), 8),
        (records.as_of(rows, rows.select("k", "p", F.col("v").alias("seen")), ["k"], "p", "seen"), 30),
        (records.in_ranges(rows, spark.createDataFrame([(0, 30)], "low int, high int"), "p", "low", "high", 3.0), 30),
        (records.active(rows, "k", ["p"], F.lit(False)), 4),
    ):
        assert got.count() == n and kept(got)
    assert set(ODD) < set(records.collapse_repeats(rows, ["k"], ["p"], ["v"]).columns)
    assert records.runs(rows, ["k"], "p", "v").agg(F.sum("run_length")).first()[0] == 30


def test_ranges_of_any_length(spark):
    """A range of very many pieces stands in few, and every row meets all of its ranges once."""
    draw = random.Random(2)
    rows = [(draw.uniform(-1e3, 1e12) if i % 3 else draw.uniform(0, 500),) for i in range(200)]
    spans = [(i, a, a + draw.choice((0.0, 0.5, 3.0, 40.0, 1e4, 1e9, 1e12))) for i, a in enumerate(draw.uniform(-100, 600) for _ in range(60))]
    made = records.in_ranges(spark.createDataFrame(rows, "at double"), spark.createDataFrame(spans, "id int, low double, high double"), "at", "low", "high", 1.0)
    got = sorted((r["at"], r["id"]) for r in made.collect())
    assert got == sorted((x, i) for (x,) in rows for i, a, b in spans if a <= x < b)
    assert records.in_ranges(spark.createDataFrame(rows, "at double"), spark.createDataFrame([], "low double, high double"), "at", "low", "high", 1.0).count() == 0


@pytest.mark.parametrize("text", ['["x "1" y"]', '{"a": ["say "5" now"]}', '{"a": "b"c": 1}', '["a""b" 1]'])
def test_a_quote_in_a_string_is_not_repaired_away(text):
    assert jsontext.read_lenient(text) is None


def test_commas_that_are_missing_are_put():
    assert jsontext.read_lenient('{"a": 1 "b": [1 2 "c" {"d": true}{"e": null}]\n"f": {}"g": 2}') == '{"a": 1, "b": [1, 2, "c", {"d": true}, {"e": null}], "f": {}, "g": 2}'
