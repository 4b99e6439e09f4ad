import pytest
from pyspark.sql import functions as F

from corpusloom.functions import nested
from corpusloom.operators import records
from corpusloom.streaming import events


def test_places_cover_ranges_nulls_and_ties(spark, tmp_path):
    rows = spark.range(1000, numPartitions=7).select(F.when(F.col("id") % 3 > 0, F.col("id") % 10).alias("n"), "id")
    got = records.numbered(rows, [F.col("n").asc_nulls_last(), F.col("id")], "place", str(tmp_path / "a")).orderBy("place").collect()
    assert [r["place"] for r in got] == list(range(1, 1001))
    assert [(r["n"], r["id"]) for r in got] == sorted(((r["n"], r["id"]) for r in got), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    assert records.numbered(rows.limit(0), [F.col("id")], "place", str(tmp_path / "b")).count() == 0


def test_tail_sample_and_origins(spark):
    rows = spark.range(10)
    assert sorted(r["id"] for r in records.tail(rows, "id", None, 3).collect()) == [7, 8, 9]
    assert [r["id"] for r in records.tail(rows, "id", 8).collect()] == [9]
    once, again = ([r["id"] for r in records.sampled(rows.repartition(n), "id", 4, 1).collect()] for n in (1, 3))
    assert once == again and len(set(once)) == 4
    got = records.origins(rows, "id", F.lit(2), F.lit(3)).collect()
    assert [r["origin"] for r in got].count("initial") == 2 and sum(r["likely_consumed"] for r in got) == 3


def test_nested_records(spark):
    rows = spark.createDataFrame([(0, "a\nb\n"), (1, ""), (2, None)], "i int, text string")
    turns = nested.timeline(F.col("text"), F.lit("p"))
    got = rows.select(F.size(turns), F.to_json(nested.transcript(turns)), nested.timeline_digest(turns)).orderBy("i").collect()
    assert [r[0] for r in got[:2]] == [3, 1] and got[2][1] is None and got[2][2] is None
    assert got[0][1] == '[{"speaker":"p","text":"a"},{"speaker":"p","text":"b"},{"speaker":"p","text":""}]'
    cut = spark.range(1).select(nested.bounded(F.array(F.lit("abc"), F.lit("de")), 1, 1), nested.bounded(F.array().cast("array<string>"), 5, 1)).first()
    assert list(cut) == [["d... [truncated 1 chars]"], []]


def test_usage_lifts_nested_reasoning(spark):
    given = ['{"prompt_tokens": 3, "x": 1, "completion_tokens_details": {"reasoning_tokens": 5}}', '{"reasoning_tokens": 1, "completion_tokens_details": {"reasoning_tokens": 5}}', "broken", None]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(given)], "i int, x string")
    got = rows.select("i", nested.usage(F.col("x")).alias("u")).orderBy("i").collect()
    assert [(r["u"]["prompt_tokens"], r["u"]["reasoning_tokens"]) for r in got] == [(3, 5), (None, 1), (None, None), (None, None)]


def test_stream_state_is_bounded_and_goes_on(spark, tmp_path):
    source, work = str(tmp_path / "in"), str(tmp_path / "work")
    rows = spark.range(30).select((F.col("id") % 3).alias("k"), F.col("id"))
    rows.filter("id < 12").repartition(3).write.parquet(source)
    stream = lambda: events.growing(spark, source, rows.schema, files=1)
    assert sorted(r["id"] for r in events.keep_last(stream(), ["k"], ["id"], 2, work).collect()) == list(range(6, 12))
    rows.filter("id >= 12").repartition(2).write.mode("append").parquet(source)
    assert sorted(r["id"] for r in events.keep_last(stream(), ["k"], ["id"], 2, work).collect()) == list(range(24, 30))
    assert sorted(r["id"] for r in events.keep_last(stream(), ["k"], ["id"], 2, work).collect()) == list(range(24, 30))
    # Of all the states that were written, the last two are there.
    assert len(list((tmp_path / "work").glob("state-*"))) == 2
    (tmp_path / "none").mkdir()
    assert events.keep_last(events.growing(spark, str(tmp_path / "none"), rows.schema), ["k"], ["id"], 2, str(tmp_path / "w2")).count() == 0


def test_stream_changes_give_the_last_of_each_key(spark, tmp_path):
    source, work = str(tmp_path / "in"), str(tmp_path / "work")
    rows = spark.range(30).select((F.col("id") % 3).alias("k"), F.col("id"))
    for part in (rows.filter("id < 12"), rows.filter("id >= 12"), None):
        if part is not None:
            part.repartition(3).write.mode("append").parquet(source)
        counts = events.growing(spark, source, rows.schema, files=1).groupBy("k").agg(F.count("*").alias("n"))
        got = {r["k"]: r["n"] for r in events.updated(counts, F.col("k"), work).collect()}
    assert got == {0: 10, 1: 10, 2: 10}


def test_done_keys_leave_the_state(spark, tmp_path):
    source, work = str(tmp_path / "in"), str(tmp_path / "work")
    first = spark.createDataFrame([("a", 1, False), ("b", 2, False)], "k string, at int, done boolean")
    second = spark.createDataFrame([("a", 3, True), ("c", 4, False)], first.schema)
    for part, want in ((first, ["a", "b"]), (second, ["b", "c"])):
        part.write.mode("append").parquet(source)
        stream = events.growing(spark, source, first.schema)
        assert sorted(r["k"] for r in events.keep_last(stream, ["k"], ["at"], 1, work, keep=~F.col("done")).collect()) == want


def test_folders_of_this_machine_only_where_the_master_is_local(spark, monkeypatch):
    class Far:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = type("Conf", (), {"get": staticmethod(lambda *a: None)}), Far

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        events.working_folder(Session)
