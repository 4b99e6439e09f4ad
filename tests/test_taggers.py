"""Tags by a dictionary join: those of the plain test of each word on each text."""

import itertools
import random

from pyspark.sql import functions as F

from corpusloom.functions.text import keyword_tags
from corpusloom.operators import taggers

number = itertools.count()
TEXTS = "id long, text string, _hash string, tags long"


def plain(text, words, limit):
    return [] if text is None else [w for w in words if w in text.lower()][:limit]


def test_as_many_words_as_a_large_dictionary_has(spark, tmp_path):
    draw = random.Random(3)
    words = sorted({"".join(draw.choices("abcdefgh", k=draw.randrange(4, 9))) for _ in range(140_000)})[:100_000]
    draw.shuffle(words)
    assert len(words) == 100_000
    texts = ["".join(draw.choices("abcdefgh ABC", k=draw.randrange(400))) for _ in range(80)]
    rows = spark.createDataFrame([(i, t, "h", i) for i, t in enumerate(texts + texts[:20])], TEXTS)
    known = spark.createDataFrame(list(enumerate(words)), "rank long, word string")
    got = {r["id"]: r["tags"] for r in taggers.dictionary_tags(rows, F.col("text"), known, F.col("word"), F.col("rank"), f"{tmp_path}/{next(number)}", 5).collect()}
    assert got == {i: plain(t, words, 5) for i, t in enumerate(texts + texts[:20])}
    assert sum(map(len, got.values())) > 100
    small = words[:200]
    few = known.filter(F.col("rank") < 200)
    both = taggers.dictionary_tags(rows, F.col("text"), few, F.col("word"), F.col("rank"), f"{tmp_path}/{next(number)}", 3, "found").withColumn("plain", keyword_tags(F.col("text"), small, 3))
    assert both.filter("found <> plain").count() == 0 and both.columns == ["id", "text", "_hash", "tags", "found", "plain"]


def test_short_empty_and_strange_words(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(taggers, "PIECE", 7)  # words across pieces
    words = ["Über", "", "a", "ßx", "😀😀😀b", "x\ny", "the longest word of all of them", "A", ".*", "zz"]
    texts = [None, "", "a", "ÜBER\nx\ny and the Longest word of all of them", "😀😀😀😀b .*", "ßx" * 9, "q" * 40 + "über", "zqz", "Z" * 15]
    known = spark.createDataFrame([*enumerate(words), (99, None), (99, "ÜBER")], "rank long, word string")
    rows = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)] + [(3, texts[3], None, None)], TEXTS)
    order = list(dict.fromkeys(w.lower() for w in words))
    for limit in (None, 2):
        got = taggers.dictionary_tags(rows, F.col("text"), known, F.col("word"), F.col("rank"), f"{tmp_path}/{next(number)}", limit).collect()
        assert len(got) == len(texts) + 1
        for r in got:
            assert r["tags"] == plain(r["text"], order, limit), r["text"]
    none = taggers.dictionary_tags(rows, F.col("text"), known.limit(0), F.col("word"), F.col("rank"), f"{tmp_path}/{next(number)}")
    assert [r["tags"] for r in none.collect()] == [[]] * 10
    assert taggers.dictionary_tags(rows.limit(0), F.col("text"), known, F.col("word"), F.col("rank"), f"{tmp_path}/{next(number)}").count() == 0


def test_words_are_keyed_by_their_rarest_part(spark):
    texts = spark.createDataFrame([(str(i), f"the thing {i}") for i in range(50)] + [("q", "the quiz")], "hash string, text string")
    words = spark.createDataFrame([("the quiz", 1), ("the thing", 2), ("the zebra", 3)], "word string, rank long")
    keys = {r["word"]: r["gram"] for r in taggers.keyed_words(texts, words, [3]).collect()}
    assert set(keys) == {"the quiz", "the thing"} and keys["the quiz"] in {" qu", "e q", "qui", "uiz"}


def test_words_are_looked_for_in_different_tokens_once(spark, tmp_path, monkeypatch):
    """Whatever part of the tokens is sent to the texts; the number of words is that of all, whatever the limit."""
    draw = random.Random(5)
    tokens = ["".join(draw.choices("abc", k=draw.randrange(1, 5))) for _ in range(60)]
    words = ["", " ", "\n", "a", "ab", "abc", "b\nc", "a b", "c\t", " b", "a\nb c", "no such", "ca", "bcab"]
    texts = [None, "", " ", *("".join(draw.choice(tokens) + draw.choice(" \n\t ") for _ in range(draw.randrange(40))) for _ in range(40))]
    known = spark.createDataFrame(list(enumerate(words)), "rank long, word string")
    rows = spark.createDataFrame([(i, t, "h", i) for i, t in enumerate(texts + texts[:9])], TEXTS)
    for sent in (0, 2000, 1 << 25):
        monkeypatch.setattr(taggers, "KNOWN", sent)
        folder = f"{tmp_path}/{next(number)}"
        got = taggers.dictionary_tags(rows, F.col("text"), known, F.col("word"), F.col("rank"), folder, 4, count="n").collect()
        assert len(got) == len(texts) + 9
        for r in got:
            assert (r["tags"], r["n"]) == (plain(r["text"], words, 4), len(plain(r["text"], words, None))), r["text"]
        seen = spark.read.parquet(f"{folder}/tokens")
        assert seen.count() == seen.select("token").distinct().count() <= len(tokens) + 1
