import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import jsontext, text
from corpusloom.operators import records
from corpusloom.sources import formats, lines


def values(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_line_file(spark, tmp_path):
    (tmp_path / "a.txt").write_text("# note\n\n 　first 　\nsecond\n\nsecond")
    rows = lines.read_lines(spark, str(tmp_path / "a.txt"))
    assert values(rows, "line_number", "text") == [(3, "first"), (4, "second"), (6, "second")]
    assert lines.count_lines(spark, str(tmp_path / "a.txt")) == 6


def test_jsonl_strict_and_lenient(spark, tmp_path):
    schema = T.StructType().add("id", "string")
    (tmp_path / "a.jsonl").write_text('{"id": "x"}\n\n[1]\n"s"\n{"id": "y"}')
    assert values(lines.read_jsonl_strict(spark, str(tmp_path / "a.jsonl"), schema), "id") == [("x",), ("y",)]
    (tmp_path / "b.jsonl").write_text('{"id": "x"}\n{"id": \n[1]\n')
    good, bad = lines.read_jsonl_lenient(spark, str(tmp_path / "b.jsonl"), schema)
    assert values(good, "id") == [("x",)]
    assert values(bad, "reason") == [("not JSON",), ("not an object",)]
    with pytest.raises(Exception, match="not JSON"):
        lines.read_jsonl_strict(spark, str(tmp_path / "b.jsonl"), schema).collect()


def test_line_numbers_over_blocks_and_files(spark, tmp_path):
    for name, n in (("a", 5000), ("b", 300)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i}\n" for i in range(1, n + 1)))
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        rows = lines.physical_lines(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 5
        got = values(rows.select(F.substring_index("file", "/", -1).alias("f"), "line_number", "value"), "f", "line_number", "value")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
    assert got == sorted((f"{x}.txt", i, f"{x}{i}") for x, n in (("a", 5000), ("b", 300)) for i in range(1, n + 1))


def test_missing_and_empty_line_files(spark, tmp_path):
    (tmp_path / "none.txt").write_text("\n# only a note\n  \n")
    with pytest.raises(ValueError, match="no lines"):
        lines.read_lines(spark, str(tmp_path / "none.txt"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lines.read_lines(spark, str(tmp_path / "missing.txt"))
    assert lines.read_lines_if_there(spark, str(tmp_path / "missing.txt")).collect() == []
    assert lines.read_lines_if_there(spark, str(tmp_path / "none.txt")).collect() == []
    assert (lines.count_lines(spark, str(tmp_path / "missing.txt")), lines.count_lines(spark, str(tmp_path / "none.txt"))) == (0, 3)


def test_versions_are_ordered_and_read_back(spark, tmp_path):
    store = lines.Versions(spark, str(tmp_path / "v"))
    rows = spark.createDataFrame([("a", None), ("b", 1)], "id string, n int")
    assert store.read(rows.schema).collect() == [] and store.numbers() == []
    assert [store.replace(rows), store.replace(store.read(rows.schema).filter("n = 1"))] == [1, 2]
    assert values(store.read(rows.schema), "id", "n") == [("b", 1)]
    assert sorted(r["id"] for r in store.read(rows.schema, 1).collect()) == ["a", "b"]
    # A writer that failed before its commit has left a folder, and the current version is what it was.
    rows.write.json(str(tmp_path / "v" / "data" / "000000003-x"))
    assert store.numbers() == [1, 2] and store.replace(rows.limit(0)) == 3 and store.read(rows.schema).count() == 0
    with pytest.raises(ValueError, match="no version 9"):
        store.read(rows.schema, 9)


def test_documents_and_folder_digest(spark, tmp_path):
    folder = tmp_path / "d"
    folder.mkdir()
    (folder / "k_1.json").write_text('{"id": 1}')
    (folder / "a.txt").write_text("text")
    assert lines.find_document(spark, str(folder), "k/1").count() == 1
    assert lines.find_document(spark, str(folder), "other").count() == 0
    each = "\n".join(f"{n}\n{hashlib.sha256(t.encode()).hexdigest()}" for n, t in (("a.txt", "text"), ("k_1.json", '{"id": 1}')))
    assert lines.folder_digest(spark, str(folder)) == hashlib.sha256(each.encode()).hexdigest()


def test_dead_letters_have_time_attempt_and_context(spark, tmp_path):
    (tmp_path / "b.jsonl").write_text('{"id": "x"}\n{"id": \n[1]\n')
    _, bad = lines.read_jsonl_lenient(spark, str(tmp_path / "b.jsonl"), T.StructType().add("id", "string"))
    rows = lines.dead_letters(bad, 3, {"run": "r1"}, F.lit("2024-01-02 03:04:05.678").cast("timestamp"))
    assert values(rows, "created_at", "attempt", "error_type", "error", "context") == [
        ("2024-01-02T03:04:05+00:00", 3, "not_JSON", 'not JSON: {"id": ', '{"run":"r1"}'),
        ("2024-01-02T03:04:05+00:00", 3, "not_an_object", "not an object: [1]", '{"run":"r1"}'),
    ]
    assert lines.dead_letters(bad, 1, {}).filter("created_at RLIKE '^20[0-9-]+T[0-9:]+[+]00:00$'").count() == 2


def test_a_page_is_cut_before_corrupt_lines_go(spark):
    rows = spark.createDataFrame([(0, '{"a": 1}'), (1, "broken"), (2, " "), (3, '{"a": 2}'), (4, "[1]"), (5, '{"a": 3}')], "pos int, line string")
    page = lambda *a: [(r["pos"], r["total"]) for r in records.page_of_lines(rows, "pos", "line", *a).collect()]
    assert page(0, 2) == [(5, 5)] and page(1, 2) == [(3, 5)] and page(3, 0) == [] and page(4, 9) == [(0, 5)] and page(9, 9) == []


def test_as_of_and_ranges_at_their_edges(spark):
    rows = spark.createDataFrame([("a", 5, 1), ("a", 1, 2), ("b", 9, 3), (None, 4, 4)], "k string, t int, id int")
    told = spark.createDataFrame([("a", 5, "x"), ("a", 2, "w"), ("b", 10, "z"), (None, 1, "n"), ("a", 4, None)], "k string, t int, v string")
    assert values(records.as_of(rows, told, ["k"], "t", "v"), "id", "v") == [(1, "x"), (2, None), (3, None), (4, "n")]
    assert records.as_of(rows, told.filter("k = 'a' AND t = 4"), ["k"], "t", "v").filter("v IS NOT NULL").count() == 0
    points = spark.createDataFrame([(x,) for x in (-1.5, 0.0, 9.99, 10.0, 25.0)] + [(None,)], "x double")
    ranges = spark.createDataFrame([("in", 0.0, 10.0), ("wide", -100.0, 25.0), ("empty", 10.0, 10.0), ("turned", 5.0, 1.0), ("none", None, 3.0)], "n string, b double, e double")
    got = values(records.in_ranges(points, ranges, "x", "b", "e", 10.0), "n", "x")
    assert got == [("in", 0.0), ("in", 9.99), ("wide", -1.5), ("wide", 0.0), ("wide", 9.99), ("wide", 10.0)]


def test_pairs_of_one_piece_are_dealt_out(spark):
    """All rows and ranges lie in one piece: as many pairs as before, and no task has more than a few hundredths of them."""
    points = spark.range(6000).coalesce(1).select(F.col("id").alias("p"), (F.col("id") % 97 / 10).alias("x"), F.create_map("id", "id").alias("m"))
    ranges = spark.range(5000).select(F.col("id").alias("r"), (F.col("id") % 89 / 10).alias("b"), (F.col("id") % 89 / 10 + 0.35).alias("e"))
    given = ranges.unionByName(spark.range(1).selectExpr("-1L r", "-1e3D b", "1e3D e")).coalesce(1)
    got = records.in_ranges(points, given, "x", "b", "e", 10.0)
    want = points.crossJoin(ranges).filter("x >= b AND x < e").select("p", "r")
    assert got.filter("r >= 0").selectExpr("count(*) n", "sum(hash(p, r)) h").first() == want.selectExpr("count(*) n", "sum(hash(p, r)) h").first()
    assert got.filter("r < 0").count() == 6000 and got.columns == ["p", "x", "m", "r", "b", "e"]
    shares = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(shares) < 0.6 * sum(shares) and len(shares) >= 3


def test_rows_and_ranges_of_a_piece_are_sent_as_often_however_many(spark, monkeypatch, tmp_path):
    """Twice the rows and ranges are sent twice as often, not four times; files of the pairs are small; equal ranges stay apart."""
    monkeypatch.setattr(records, "CHUNK", 25)
    sent, frame = [], type(spark.range(0))
    monkeypatch.setattr(frame, "repartition", lambda self, *a, f=frame.repartition: (sent.append(self.count()), f(self, *a))[1])
    for n in (2000, 4000):
        points = spark.range(n).select(F.col("id").alias("p"), (F.hash("id") % 1000 / 100).alias("x")).filter("x >= 0")
        ranges = spark.range(n).select(F.col("id").alias("r"), (F.col("id") % 1000 / 100).alias("b"), F.create_map("id", "id").alias("m"))
        ranges = ranges.select("r", "b", (F.col("b") + 5).alias("e"), "m")
        got = records.in_ranges(points, ranges, "x", "b", "e", 10.0)
        want = points.crossJoin(ranges).filter("x >= b AND x < e").agg(F.count("*"), F.sum(F.hash("p", "r"))).first()
        assert got.agg(F.count("*"), F.sum(F.hash("p", "r"))).first() == want and got.columns == ["p", "x", "r", "b", "e", "m"]
    assert len(sent) == 4 and sum(sent[:2]) < 20 * 2000 and sum(sent[2:]) < 2.5 * sum(sent[:2])
    got.select("p", "r").write.parquet(f"{tmp_path}/pairs")
    assert sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet")) < 0.6 * want[0]
    same = spark.range(5000).selectExpr("2.0D b", "5.0D e")
    assert records.in_ranges(points, same, "x", "b", "e", 10.0).count() == 5000 * points.filter("x >= 2 AND x < 5").count()


def test_tables_in_other_formats(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a "b", c', 0.5), (2, "", None), (3, None, 1.5), (4, "two\nlines", 0.0)], "i long, s string, x double")
    for kind in formats.OPTIONS:
        assert sorted(map(tuple, formats.round_trip(rows, kind, str(tmp_path / kind)).collect())) == sorted(map(tuple, rows.collect()))


def test_lenient_json(spark):
    given = [
        '```json\n{"b": 1, "a": 2}\n```', 'So: {"a": 1}. Done', '{"a": 1\n "b": 2}', '{"a": ""}', "none", None,
        '{"a": 1 "b": 2}', '[{"a": 1} {"b": 2}]', '{"a": [[1] [2]] "b": true "c": null}', '{"a": "x" "b": ""}', '{"a": "he said "no" twice"}', '{"a": "1 2 {3} [4]" "b": -1.5e3}',
    ]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(given)], "i int, x string")
    got = dict(values(rows.select("i", jsontext.lenient_json(F.col("x")).alias("y")).filter("y is not null"), "i", "y"))
    assert got == {
        0: '{"a": 2, "b": 1}', 1: '{"a": 1}', 2: '{"a": 1, "b": 2}', 3: '{"a": ""}', 6: '{"a": 1, "b": 2}',
        7: '[{"a": 1}, {"b": 2}]', 8: '{"a": [[1], [2]], "b": true, "c": null}', 11: '{"a": "1 2 {3} [4]", "b": -1500.0}',
    }


def test_schema_errors_and_wrapping(spark):
    schema = {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer"}, "l": {"type": "array", "items": {"enum": [1, 2]}}}, "additionalProperties": False}
    assert jsontext.schema_errors({"n": True, "l": [1, 3], "z": 0}, schema) == ["$.z: not allowed", "$.n: not integer", "$.l[1]: not in enum"]
    rows = spark.createDataFrame([('{"r": {"a": 1}}',), ('{"a": 2}',), ('{"b": 3}',), ('{"r": {"b": 1}}',), ("[1]",), ("broken",), (None,)], "x string")
    got = [r[0] for r in rows.select(jsontext.wrapped_or_bare(F.col("x"), "r", "a int")).collect()]
    assert [r and r["a"] for r in got] == [1, 2, None, None, None, None, None]


def test_upsert_replaces_all_of_a_key_and_appends(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 2, 2), ("a", 3, 3)], "k string, v int, pos int")
    new = spark.createDataFrame([("a", 9, 1), ("c", 8, 2), ("a", 10, 3)], "k string, v int, pos int")
    assert values(records.upsert(old, new, "k", "pos"), "pos", "k", "v") == [(1, "a", 10), (2, "b", 2), (6, "c", 8)]


def test_empty_tables_and_nulls(spark):
    none = spark.createDataFrame([], "k string, pos int")
    assert records.first_of_each(none, F.col("k"), "pos").count() == 0
    assert records.with_group(none, F.col("k"), "pos").count() == 0
    some = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "k string, pos int")
    assert [r["pos"] for r in records.by_key_order(some, F.col("k"), "pos").collect()] == [3, 1, 2]
    assert values(records.first_of_each(some, F.col("k"), "pos"), "pos") == [(1,), (3,)]


def test_small_functions(spark):
    row = spark.range(1).select(
        text.clip(F.lit("abcdef"), 2), text.index_from_id(F.lit("c-007"), "c-"), text.index_from_id(F.lit("x"), "c-"),
        records.last_elements(F.array().cast("array<int>"), 2), records.percent_done(F.lit(1), F.lit(0)),
        records.actual_turns(F.lit(None).cast("int"), F.array(F.lit(1)), F.lit(None).cast("array<int>")),
    ).first()
    assert list(row) == ["ab... [truncated 4 chars]", 7, None, [], 0, 1]
    limits = {"min_turns": F.lit(3), "max_turns": F.lit(2), "target_turns": F.lit(None).cast("int")}
    checks = spark.range(1).select(records.range_errors(limits), records.range_errors({"target_turns": F.lit(0)}), records.range_errors({})).first()
    assert list(checks) == [["max_turns is below min_turns"], ["target_turns must be above 0"], []]
