"""State in the state store, over arrivals and restarts; the tail source."""

import datetime

from pyspark.sql import functions as F

from corpusloom.sources.tail import TailReader, tail
from corpusloom.streaming import events as streaming
from corpusloom.streaming import state

KIND = "k string, at timestamp, n long, done boolean"


def arrive(spark, folder, rows):
    t0 = datetime.datetime(2024, 1, 1)
    made = [(k, t0 + datetime.timedelta(minutes=m), n, d) for k, m, n, d in rows]
    spark.createDataFrame(made, KIND).write.mode("append").parquet(f"{folder}/in")
    return streaming.growing(spark, f"{folder}/in", spark.createDataFrame([], KIND).schema, files=1000)


def test_done_keys_leave_the_state_and_late_rows_dont_bring_them_back(spark, tmp_path):
    folder = str(tmp_path)
    run = lambda rows: {r["k"]: r["n"] for r in state.active_keys(arrive(spark, folder, rows), "k", ["at", "n"], "done", "at", "10 minutes", folder).collect()}
    held = lambda: {r["k"] for r in state.held(spark, folder, "last").collect()}
    assert run([("a", 1, 1, False), ("a", 2, 2, False), ("b", 3, 3, True), ("b", 3, 2, False)]) == {"a": 2}
    assert held() == {"a", "b"}
    assert run([("b", 1, 9, False), ("c", 4, 4, False)]) == {"a": 2, "c": 4}  # older than what b is done by
    assert run([("c", 60, 5, True), ("d", 61, 6, False)]) == {"a": 2, "d": 6}
    assert run([("b", 70, 7, False), ("e", 120, 8, False)]) == {"a": 2, "d": 6, "b": 7, "e": 8}
    run([("f", 200, 9, True)])
    assert "c" not in held()  # its timer went off behind the watermark


def test_last_rows_over_restarts(spark, tmp_path):
    folder, want = str(tmp_path), []
    for batch in range(3):
        rows = [(k, (7 * i + batch) % 50, 100 * batch + i, False) for i in range(12) for k in ("x", "y")][: 24 - batch]
        want += rows
        got = state.last_rows(arrive(spark, folder, rows), "k", ["at", "n"], 4, folder)
        expected = sorted(n for k in ("x", "y") for _, n in sorted((m, n) for q, m, n, _ in want if q == k)[-4:])
        assert sorted(r["n"] for r in got.collect()) == expected


def test_last_rows_take_nulls_as_last_and_no_frames(spark, tmp_path, monkeypatch):
    """Rows without a place come last and keep their nulls; no frame is made for a key."""
    folder = str(tmp_path)
    monkeypatch.setattr(state, "_latest", None)
    for rows, want in (([("a", 3, 1, True), ("a", 3, None, False), ("b", 1, 2, None)], {("a", 1), ("a", None), ("b", 2)}), ([("a", 9, 5, True), ("b", 0, 1, True), ("c", 1, None, None)], {("a", None), ("a", 5), ("b", 1), ("b", 2), ("c", None)})):
        got = state.last_rows(arrive(spark, folder, rows), "k", ["at", "n"], 2, folder)
        assert {(r["k"], r["n"]) for r in got.collect()} == want and got.count() == len(want)


def test_the_tail_gives_each_row_once(spark, tmp_path):
    folder, seen = str(tmp_path), []
    for low, high in ((0, 1000), (1000, 1001), (1001, 1400), (1400, 1400)):
        spark.range(low, high).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("x")).write.mode("append").parquet(f"{folder}/in")
        streaming.drain(tail(spark, f"{folder}/in", "id long, x string", "id", cold=50), folder)
        seen = sorted(r["id"] for r in spark.read.parquet(f"{folder}/rows").collect())
        assert seen == list(range(950, high))


def test_ranges_of_ids_cover_a_batch_once(spark, tmp_path):
    spark.range(5, 40).write.parquet(f"{tmp_path}/in")
    for cold, parts in ((10, 3), (100, 8), (35, 1)):
        reader = TailReader(spark.range(1).schema, {"path": f"{tmp_path}/in", "id": "id", "cold": str(cold), "partitions": str(parts)})
        start, end = reader.initialOffset(), reader.latestOffset()
        cut = reader.partitions(start, end)
        got = [x for p in cut for b in reader.read(p) for x in b.column(0).to_pylist()]
        assert sorted(got) == list(range(max(5, 40 - cold), 40)) and len(cut) <= parts
    assert reader.partitions(end, end) == []
