"""Pages by a sparse index: equal to the lines of the files, from the blocks that hold them alone."""

import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.sources.lineindex import LineIndex


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    yield spark
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def drawn(n, seed):
    draw = random.Random(seed)
    kinds = ["", "  ", "\t\r", "[1]", "{broken", '{"ü": 1}']
    return [draw.choice(kinds) if draw.random() < 0.4 else json.dumps({"n": i, "t": "x" * draw.randrange(60)}) for i in range(n)]


def wanted(files, offset, limit):
    """By plain Python: (file name, line number, value) of a page."""
    full = [(name, k, v) for name, lines in sorted(files.items()) for k, v in enumerate(lines, 1) if v.strip()][::-1]
    page = full[offset : offset + limit]
    return [x for x in page if x[2].lstrip().startswith("{") and x[2] != "{broken"], len(full)


def test_pages_are_those_of_the_files(small_splits, tmp_path):
    spark, data = small_splits, tmp_path / "a b+%41"
    data.mkdir()
    files = {"a.jsonl": drawn(700, 1), "b.jsonl": drawn(300, 2)}
    (data / "a.jsonl").write_bytes(("\n".join(files["a.jsonl"]) + "\n").encode())
    (data / "b.jsonl").write_bytes(b"\xef\xbb\xbf" + "\n".join([*files["b.jsonl"][:-1], '{"last": 1}']).encode())
    files["b.jsonl"][-1] = '{"last": 1}'
    (data / "empty.jsonl").write_bytes(b"")
    index = LineIndex(spark, str(tmp_path / "index"), every=16)
    assert index.extend(str(data)) == 2 and index.extend(str(data)) == 0
    for step in range(2):
        for offset, limit in ((0, 1), (0, 50), (37, 20), (150, 300), (640, 40), (10_000, 5)):
            want, total = wanted(files, offset, limit)
            got = index.page(offset, limit).orderBy("place").collect()
            assert [(r["file"].rpartition("/")[2], r["line_number"], r["value"]) for r in got] == want
            assert {r["total"] for r in got} <= {total}
        (data / "c.jsonl").write_bytes(b'\n{"n": 0}\n\n')
        files["c.jsonl"] = ["", '{"n": 0}', ""]
        assert index.extend(str(data)) == 1 - step
    name = index._files().filter(F.col("file").endswith("a.jsonl")).first()["file"]
    got = index.between(name, 100, 160).orderBy("line_number").collect()
    assert [(r["line_number"], r["value"]) for r in got] == [(k, files["a.jsonl"][k - 1]) for k in range(100, 161)]


def test_a_page_reads_two_blocks_of_many(small_splits, tmp_path):
    spark, data = small_splits, tmp_path / "data"
    data.mkdir()
    (data / "a.jsonl").write_text("".join(f'{{"n": {i}}}\n' for i in range(20_000)))
    index = LineIndex(spark, str(tmp_path / "index"), every=100)
    index.extend(str(data))
    assert index._blocks(index._files().withColumn("after", F.lit(0))).count() >= 200
    for offset in (0, 7_777, 19_950):
        blocks = index.blocks_of_page(offset, 50)
        assert blocks.count() <= 2 and index.read(blocks).count() <= 200
        assert [json.loads(r["value"])["n"] for r in index.page(offset, 50).orderBy("place").collect()] == list(range(19_999 - offset, 19_949 - offset, -1))


def test_what_is_not_plain_text_is_an_error(spark, tmp_path):
    spark.createDataFrame([(f"line {i}",) for i in range(100)], "v string").write.option("compression", "gzip").text(str(tmp_path / "data"))
    with pytest.raises(PySparkException, match="not a plain text file"):
        LineIndex(spark, str(tmp_path / "index")).extend(str(tmp_path / "data"))
    assert not (tmp_path / "index" / "files").exists()
