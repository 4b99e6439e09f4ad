"""Copy-on-write merges: files that hold no key of a merge stay, and the rows are those of an upsert of the whole table."""

import random

import pytest

from corpusloom.operators import records
from corpusloom.sources.keyed import KeyedFiles

KIND = "k long, pos long, v string"


@pytest.fixture
def ranges(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_merges_touch_the_files_of_their_keys(ranges, tmp_path):
    spark, draw = ranges, random.Random(1)
    rows = spark.createDataFrame([(i // 2, i, f"v{i}") for i in range(400)], KIND)  # each key twice
    table = KeyedFiles(spark, str(tmp_path), rows.schema, "k", "pos")
    assert table.read().count() == 0 and table.touched(rows) == []
    versions, want, wanted = [table.replace(rows)], rows, [rows]
    before = table.files()
    assert len(before) == 4
    for step in range(3):
        new = spark.createDataFrame([(k, 1000 + i, f"n{step}-{i}") for i, k in enumerate([3, 5, 5, 9][: 2 + step] + [500 + step])], KIND)
        touched = table.touched(new)
        versions.append(table.merge(new))
        keys = {r["k"] for r in new.collect()}
        assert touched == [f for f in before if keys & {r["k"] for r in table._rows([f]).collect()}]
        assert 0 < len(touched) < len(before) and {*before} & {*table.files()} == {*before} - {*touched}
        want = records.upsert(want, new, "k", "pos")
        want = spark.createDataFrame(want.collect(), want.schema)
        wanted.append(want)
        before = table.files()
    gone = spark.createDataFrame([(draw.randrange(60),) for _ in range(20)] + [(10**6,)], "k long")
    versions.append(table.delete(gone))
    wanted.append(records.delete_by_key(want, gone, "k"))
    assert len({*before} & {*table.files()}) >= 2
    for number, rows in zip(versions, wanted, strict=True):
        assert sorted(map(tuple, table.read(number).collect())) == sorted(map(tuple, rows.collect()))


def test_merge_into_nothing_and_of_nothing(ranges, tmp_path):
    table = KeyedFiles(ranges, str(tmp_path), ranges.createDataFrame([], KIND).schema, "k", "pos")
    table.merge(ranges.createDataFrame([(1, 5, "a"), (1, 6, "b")], KIND))
    assert [(r["k"], r["v"]) for r in table.read().collect()] == [(1, "b")]
    files = table.files()
    table.merge(ranges.createDataFrame([], KIND))
    table.delete(ranges.createDataFrame([(7,)], "k long"))
    assert {*files} <= {*table.files()} and table.read().count() == 1
