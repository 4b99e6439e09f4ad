"""The corpus operators against their SQL, brute force, and odd tables."""

import hashlib
import itertools
import random
import textwrap
import time
from collections import defaultdict

import numpy as np
import oracle
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusloom.llm import bigru, chat, decontaminate, fmindex, imatch, licenses, mixing, secretscan, shards, simhash, templates, webpages
from corpusloom.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _key string, part string"
ODD = [
    (1, None, None, None, None, "x", "y"),
    (2, "", "en", "a", 0, "x", "y"),
    (2, "", "en", "a", 0, "x", "y"),
    (3, "Hello there, the secret = abc123456 is hidden " * 3000, "en", "a", 1, None, None),
    (None, "tiny", "en", None, 4, "x", "y"),
    (4, "12 34 !!", "fr", "b", 8, "x", "y"),
]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Tables with nulls, empty and long texts, repeated rows and clashing columns; and empty tables."""
    out = {}
    for name, rows in (("odd", ODD), ("empty", [])):
        root = tmp_path_factory.mktemp(name)
        spark.createDataFrame(rows, DOCS).write.parquet(f"{root}/documents.parquet")
        items = [(1, "hidden hello there the"), (2, None), (None, ""), (1, "hidden hello there the")] if rows else []
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
        pages = [(1, None, None), (None, "http://x/", "<p>a"), (1, "bad url", "")] if rows else []
        spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{root}/pages.parquet")
        said = [(1, 0, "user", None), (1, 0, "user", None), (None, None, None, "x<|im_end|>"), (2, 1, "as\n\\sistant", "<\\|y")] if rows else []
        spark.createDataFrame(said, "conv_id long, turn long, role string, text string").write.parquet(f"{root}/conversations.parquet")
        vectors = [(None, [1.0, float("nan")], 1), (1, None, 1), (2, [0.5, 1.0], 1), (2, [0.5, 1.0], 1), (3, [1.0, -1.0], None), (4, [None, 1.0], 1)] if rows else []
        spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{root}/embeddings.parquet")
        out[name] = str(root)
    return out


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_rows_are_those_of_the_sql(spark, name):
    oracle.compare(spark, QUERIES[name], ORACLE_SQL[name], SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_and_empty_tables(spark, odd, name):
    rows = {"op7_chat_templates": 4, "op8_pages_host_paths": 3, "op12_whitening_welford_qr": 3}.get(name, len(ODD))
    assert len(QUERIES[name](spark, odd["odd"]).collect()) == rows
    assert len(QUERIES[name](spark, odd["empty"]).collect()) == (1 if name == "op7_chat_templates" else 0)


@pytest.mark.parametrize("name", ["op2_decontaminate_fmindex", "op3_secrets_blob_ledger", "op4_mix_sainte_lague", "op6_licenses_set_join", "op7_chat_templates", "op11_lines_keep_bitmaps", "op13_merkle_manifest"])
def test_odd_rows_are_those_of_the_sql(spark, odd, name):
    oracle.compare(spark, QUERIES[name], ORACLE_SQL[name], odd["odd"])


def test_fm_index_finds_what_a_scan_finds():
    draw = random.Random(1)
    for _ in range(20):
        text = np.array([draw.randrange(4) for _ in range(draw.randrange(1, 300))] * draw.randrange(1, 3), dtype=np.int32)
        index = fmindex.FMIndex(text, 4)
        assert fmindex.suffix_array(text, 4).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        for n in (1, 2, 5):
            phrase = np.array([[draw.randrange(4) for _ in range(n)]])
            low, high = index.search(phrase, np.array([n]))
            found = sorted(index.locate(np.arange(low[0], max(low[0], high[0]))).tolist())
            assert found == [i for i in range(len(text) - n + 1) if (text[i : i + n] == phrase[0]).all()]


def test_blocks_of_items_give_the_same_and_spans_are_cut(spark, monkeypatch):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    once = sorted(map(tuple, decontaminate.contamination(docs, items).collect()))
    cut = sorted(map(tuple, decontaminate.remove_benchmark(docs, items).collect()))
    for most in (3000, 60):  # blocks of several items, and items in several blocks
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", most)
        assert len(list(decontaminate._blocks(items))) > 3
        assert sorted(map(tuple, decontaminate.contamination(docs, items).collect())) == once
        assert sorted(map(tuple, decontaminate.remove_benchmark(docs, items).collect())) == cut
    monkeypatch.undo()
    rows = spark.createDataFrame(cut, docs.schema)
    assert decontaminate.contamination(rows, items).filter("contaminated").count() == 0
    assert len(cut) == docs.count() and all(r[4] == len(r[1]) for r in cut)
    assert rows.join(docs, ["doc_id", "text"]).count() == sum(not r[-1] for r in once)


def test_windows_of_items_and_their_owners():
    """Repeated items and windows, items of one word, of none, and shorter than a window."""
    draw = random.Random(8)
    for _ in range(50):
        items = [(str(draw.randrange(6)), " ".join(draw.choices("ab", k=draw.choice((0, 1, 3, 9, 10, 11, 30)))).encode()) for _ in range(draw.randrange(9))]
        held, want = decontaminate.Phrases(items), defaultdict(set)
        names = {v: k for k, v in held.symbols.items()}
        for item, text in items:
            words = text.split()
            for i in range(max(len(words) - 10, 0) + 1 if words else 0):
                want[tuple(words[i : i + 10])].add(item)
        got = {}
        for k, (end, n) in enumerate(zip(held.ends, held.lengths, strict=True)):
            owners = [held.ids[i] for i in held.owners[held.first[k] : held.first[k + 1]]]
            assert owners == sorted(set(owners))
            got[tuple(names[x] for x in held.row[end - n : end])] = set(owners)
        assert got == want and len(held.ends) == len(want)


def test_plans_of_repeated_rows_do_not_depend_on_the_order(spark):
    """Rows of one doc_id and text that differ in other columns: each has the same plan however the rows lie."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, s, f"n{i}") for s in "abc" for i in range(4)] + [(2, "x " * 900, "d", "n")]
    runs = []
    for seed in (1, 2, 3):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string, note string").repartition(seed)
        runs.append(sorted(map(tuple, mixing.mixed_documents(docs).collect())))
    assert runs[0] and runs[0] == runs[1] == runs[2]


def test_long_items_in_pieces_have_the_same_windows(monkeypatch):
    draw = random.Random(4)
    text = " ".join(f"w{draw.randrange(50)}" for _ in range(500)).encode()
    whole = decontaminate.Phrases([("a", text)])
    words = {v: k for k, v in whole.symbols.items()}
    want = {tuple(words[x] for x in w) for w in whole.windows.tolist()}
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    pieces = list(decontaminate._pieces(text))
    parts = decontaminate.Phrases([("a", p) for p in pieces])
    words = {v: k for k, v in parts.symbols.items()}
    assert len(pieces) > 10 and {tuple(words[x] for x in w) for w in parts.windows.tolist()} == want and (parts.lengths == 10).all()


def test_language_model_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = QUERIES["op1_langid_bigru"](spark, "/root/testdata/sf0.01").join(docs, "doc_id")
    assert found.filter("held_out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_labels_are_those_of_a_slow_forward_pass():
    """The network written out byte by byte, unit by unit, against the batched one; texts of one to several pieces."""
    draw = np.random.default_rng(3)
    model = {k: draw.normal(0, 0.5, v.shape).astype(np.float32) for k, v in bigru._start(3).items()}
    soft = lambda x: x / (1 + abs(x))

    def states(piece, side):
        h, out, n = [0.0] * bigru.HIDDEN, [], bigru.HIDDEN
        for byte in piece:
            sums = [float(model[f"in_{side}"][byte, j]) + sum(h[i] * float(model[f"rec_{side}"][i, j]) for i in range(n)) for j in range(2 * n)]
            gate = [0.5 + 0.5 * soft(x) for x in sums[:n]]
            new = [soft(x) for x in sums[n:]]
            h = [c + z * (a - c) for a, z, c in zip(h, gate, new, strict=True)]
            out.append(h)
        return out

    def slow(text):
        total = [0.0] * 3
        for at in range(0, len(text), bigru.PIECE):
            piece = text[at : at + bigru.PIECE]
            both = zip(states(piece, "f"), reversed(states(piece[::-1], "b")), strict=True)
            for f, b in both:
                logits = [float(model["bias"][c]) + sum(x * float(w) for x, w in zip(f + b, model["out"][:, c], strict=True)) for c in range(3)]
                top = [np.exp(x) for x in logits]
                total = [t + x / sum(top) for t, x in zip(total, top, strict=True)]
        return [t / len(text) for t in total]

    texts = [b"a", "héllo wörld".encode(), b"x" * 128, b"some longer text " * 20, bytes(range(1, 200))]
    got = bigru.label_texts(texts, model)
    for t, row in zip(texts, got, strict=True):
        assert row == pytest.approx(slow(t), abs=2e-4)


def test_the_sample_is_that_of_a_full_ranking(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    seen = []
    monkeypatch.setattr(bigru, "train", lambda texts, labels, n: seen.append((texts, labels.tolist(), n)) or {})
    monkeypatch.setattr(bigru, "SAMPLE", 20)
    for room in (10**9, 8, 1):
        monkeypatch.setattr(bigru, "ROOM", room)
        bigru.learn(docs)
    rare = docs.withColumn("text", F.when(F.pmod("doc_id", F.lit(40)) == 0, F.col("text")).otherwise("12"))  # few texts have a letter
    for room in (10**9, 2):
        monkeypatch.setattr(bigru, "ROOM", room)
        bigru.learn(rare)
    assert seen[0] == seen[1] == seen[2] and seen[3] == seen[4] and seen[0] != seen[3]


def test_gradients_are_those_of_differences(monkeypatch):
    monkeypatch.setattr(bigru, "HIDDEN", 3)
    draw = np.random.default_rng(0)
    table, rec = draw.normal(size=(256, 6)).astype(np.float32), draw.normal(size=(3, 6)).astype(np.float32)
    seq, mask = draw.integers(0, 256, (7, 4)), np.ones((7, 4, 1), np.float32)
    weight = draw.normal(size=(7, 4, 3)).astype(np.float32)
    _, kept = bigru._forward(seq, mask, table, rec)
    _, grad = bigru._backward(seq, mask, rec, kept, weight)
    for i, j in ((0, 0), (1, 4), (2, 5)):
        moved = []
        for step in (1e-2, -1e-2):
            other = rec.copy()
            other[i, j] += step
            moved.append(float((bigru._forward(seq, mask, table, other)[0] * weight).sum()))
        assert grad[i, j] == pytest.approx((moved[0] - moved[1]) / 2e-2, rel=0.05, abs=0.02)


def test_ledger_scans_only_unseen_pairs(spark, tmp_path):
    first = spark.createDataFrame([("a", "password=abcdef"), ("b", "password=abcdef")], "path string, text string")
    rules = secretscan.RULES[:2]
    assert [len(r["findings"]) for r in secretscan.scan(first, str(tmp_path), rules).collect()] == [1, 1]
    second = first.union(spark.createDataFrame([("c", "AKIA" + "A" * 16)], first.schema))
    assert sum(len(r["findings"]) for r in secretscan.scan(second, str(tmp_path), rules).collect()) == 3
    secretscan.scan(second, str(tmp_path), secretscan.RULES[:3]).collect()
    pairs = [(r["blob"], x) for r in secretscan.read_ledger(spark, str(tmp_path)).collect() for x in r["seen"]]
    assert len(pairs) == len(set(pairs)) == 2 * 3


def test_half_a_million_hits_in_a_text(spark, tmp_path):
    """Time in proportion to the hits: four times as many take about four times as long, not sixteen times."""
    took = []
    for n in (125_000, 500_000):
        history = spark.range(1).select(F.lit("p").alias("path"), F.repeat(F.lit("é token=abcdef12 "), n).alias("text"))
        began = time.time()
        found = secretscan.scan(history, f"{tmp_path}/{n}").select("path", F.col("findings").getItem(n - 1).alias("last"), F.size("findings").alias("n"))
        (row,) = found.collect()
        took.append(time.time() - began)
        assert row["n"] == n and (row["last"]["start"], row["last"]["end"]) == (17 * (n - 1) + 2, 17 * n - 1)
    assert took[1] < 60 and took[1] < 10 * took[0]


def test_ledger_keeps_clashing_columns_and_only_looks_up_what_is_there(spark, tmp_path):
    rows = [("p", "password=abcdef", 1, "x"), ("q", "password=abcdef", 2, "y"), ("r", None, 3, "z")]
    history = spark.createDataFrame(rows, "path string, text string, _blob int, blob string")
    first = secretscan.scan(history, str(tmp_path), secretscan.RULES[:1])
    assert first.columns == ["path", "text", "_blob", "blob", "findings"]
    got = {r["path"]: (r["_blob"], len(r["findings"])) for r in first.collect()}
    assert got == {"p": (1, 1), "q": (2, 1), "r": (3, 0)}
    other = spark.createDataFrame([("s", "token: 'abcdefgh'"), ("t", "password=abcdef")], "path string, text string")
    found = secretscan.scan(other, str(tmp_path), secretscan.RULES[:1]).collect()
    assert {r["path"]: [(x["start"], x["end"]) for x in r["findings"]] for r in found} == {"s": [(0, 16)], "t": [(0, 15)]}
    assert secretscan.read_ledger(spark, str(tmp_path)).count() == 3


def test_mix_keeps_to_targets_and_limits(spark):
    rows = QUERIES["op4_mix_sainte_lague"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id")
    assert rows.filter("taken > 3 * size").count() == 0
    for r in rows.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect():
        assert r["t"] == round(r["g"])
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = mixing.mixed_documents(docs)
    words = mixed.select(F.sum(mixing.n_words(F.col("text")))).first()[0]
    assert words == QUERIES["op4_mix_sainte_lague"](spark, SF).agg(F.sum("taken")).first()[0]


def test_mix_of_few_words_and_repeated_rows(spark):
    """Sources of less than a block keep their words, repeated rows have a plan each, and no row has a text it shouldn't."""
    words = lambda n, w: " ".join(f"{w}{i}" for i in range(n))
    rows = [(1, words(10, "a"), "a"), (2, words(3, "b"), "b"), (2, words(3, "b"), "b"), (3, None, "c"), (4, "", "c"), (None, words(2, "d"), None), (5, words(900, "e"), "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for own in (docs, docs.filter("doc_id < 3"), docs.filter("doc_id IN (3, 4)")):
        plan = mixing.mix(own.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"))).collect()
        taken, target = defaultdict(int), {}
        for r in plan:
            assert 0 <= r["taken"] <= 3 * r["size"]
            taken[r["source"]] += r["taken"]
            target[r["source"]] = r["target"]
        assert all(abs(taken[s] - t) <= 0.5 for s, t in target.items())
        mixed = mixing.mixed_documents(own).collect()
        given = defaultdict(int)
        for r in mixed:
            given[r["source"]] += len(r["text"].split())
        assert {s: n for s, n in taken.items() if n} == given
        whole = {" " + r["text"] + " " for r in own.collect() if r["text"]}
        assert all(any(f" {line} " in w for w in whole) for r in mixed for line in r["text"].split("\n"))


def test_seats_by_highest_quotients_one_by_one(spark):
    """Shares of all sizes; the candidates are few, and the seats are those that are handed out one by one."""
    draw = random.Random(6)
    rows, want = [], {}
    for key in ("a", None, "c", "d"):
        shares = [float(draw.choice((0, 1, 5, 5, 7, 30, 900, draw.randrange(1, 4000)))) for _ in range(60)]
        shares[0] = 1.0
        seats = draw.randrange(1, 400)
        got = [0] * len(shares)
        for _ in range(seats):
            best = max(range(len(shares)), key=lambda i: (shares[i] / (2 * got[i] + 1), -i))
            got[best] += 1
        rows += [(key, i, x, sum(shares) / seats, seats) for i, x in enumerate(shares)]
        want |= {(key, i): n for i, n in enumerate(got)}
    table = spark.createDataFrame(rows, "source string, shard long, share double, unit double, seats long")
    assert {(r["source"], r["shard"]): r["quota"] for r in mixing.apportion(table, ["source"], "shard").collect()} == want
    one = table.filter("source = 'a'").drop("source")
    assert {r["shard"]: r["quota"] for r in mixing.apportion(one, [], "shard").collect()} == {i: n for (k, i), n in want.items() if k == "a"}


def test_a_source_of_many_shards_has_few_candidates(spark, monkeypatch):
    shards = spark.range(20_000).select(F.lit("a").alias("source"), F.col("id").alias("shard"), (F.pmod(F.xxhash64("id"), F.lit(500)) + 1).cast("double").alias("share"))
    total = shards.agg(F.sum("share")).first()[0]
    made = []
    first = mixing.places
    monkeypatch.setattr(mixing, "places", lambda rows, *a: made.append(rows.count()) or first(rows, *a))
    got = mixing.apportion(shards.withColumns({"unit": F.lit(total / 33_333), "seats": F.lit(33_333)}), ["source"], "shard")
    assert got.agg(F.sum("quota")).first()[0] == 33_333 and 0 < made[0] <= 4 * 20_000


def test_mix_limits_small_sources(spark):
    sources = spark.createDataFrame([("a", 10), ("b", 10), ("c", 1000)], "source string, words long")
    got = {r["source"]: r["target"] for r in mixing.targets(sources).collect()}
    assert got == {"a": 30.0, "b": 30.0, "c": 960.0}


def test_fingerprints_by_brute_force(spark):
    """All columns, with the lexicon from plain counts, terms hashed one by one and subsets made anew."""
    rows = QUERIES["op5_fingerprints_imatch"](spark, SF).collect()
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: -r["doc_id"])
    terms = lambda text: {w for w in "".join(c.lower() if c < "\x80" and c.isalnum() else c if c >= "\x80" else " " for c in text).split(" ") if w}
    counts = defaultdict(int)
    for d in docs:
        for w in terms(d["text"]):
            counts[w] += 1
    band = {xxhash.xxh64_intdigest(w.encode()) for w, n in counts.items() if 0.002 * len(docs) <= n <= 0.05 * len(docs)}
    assert band == {int(x) for x in imatch.lexicon(spark.read.parquet(f"{SF}/documents.parquet"))}

    def parts(text):
        every = sorted(xxhash.xxh64_intdigest(w.encode()) for w in terms(text))
        kept = [h for h in every if h in band] or every or [xxhash.xxh64_intdigest(text.encode(), 42)]
        out = []
        for k, share in enumerate([256] + [171] * 3 + [32] * 4 + [4] * 8 + [1] * 16):
            mixed = [(h ^ (k + 1) * 0x9E3779B97F4A7C15 % 2**64) * 0xD6E8FEB86659FD93 % 2**64 >> 56 for h in kept]
            own = [h for h, m in zip(kept, mixed, strict=True) if m < share]
            out.append(1 + xxhash.xxh32_intdigest(b"".join(h.to_bytes(8, "little") for h in own), 42 + k) % 0xFFFF if own else 0)
        return out

    text = lambda p: "".join(f"{x:04x}" for x in p)
    like = lambda a, b: sum(x == y for x, y in zip(a, b, strict=True) if x or y) / sum(1 for x, y in zip(a, b, strict=True) if x or y)
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(by_id) == len(docs)
    for k, d in enumerate(docs):
        follow, n = docs[(k + 1) % len(docs)]["text"], len(d["text"])
        changed = d["text"][: n - n // 2] + follow[: n // 2]
        own, other = parts(d["text"]), parts(changed)
        want = (d["doc_id"], n, hashlib.sha256(changed.encode()).hexdigest(), text(own), text(other), like(own, other), like(own, parts(follow)))
        assert tuple(by_id[d["doc_id"]]) == want


def test_the_lexicon_is_the_same_however_it_is_counted(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    once = imatch.lexicon(docs).tolist()
    for sent, held in ((0, imatch.HELD), (imatch.SENT_TERMS, 300), (0, 300)):
        monkeypatch.setattr(imatch, "SENT_TERMS", sent)
        monkeypatch.setattr(imatch, "HELD", held)
        assert imatch.lexicon(docs).tolist() == once and len(once) > 100


def test_containment_join_by_brute_force(spark):
    draw = random.Random(2)
    blocks = [(i, sorted(draw.sample(range(14), draw.randrange(1, 12)))) for i in range(200)]
    known = [(i, sorted(draw.sample(range(14), draw.randrange(1, 9)))) for i in range(12)]
    got = licenses.containment_join(spark.createDataFrame(blocks, "block int, tokens array<int>"), spark.createDataFrame(known, "template int, tokens array<int>"), 0.8)
    want = {(b, t) for (b, x), (t, y) in itertools.product(blocks, known) if len(set(x) & set(y)) >= licenses.needed(len(y), 0.8)}
    assert {(r["block"], r["template"]) for r in got.collect()} == want


def test_wrapped_notices_are_found(spark):
    """Notices that are wrapped at 60 columns, in comments or not, have the label of their template, and words far apart none."""
    rows = []
    for i, (text, *_) in enumerate(licenses.TEMPLATES):
        lines = textwrap.wrap(text, 60 if len(text) > 60 else 24)
        rows += [(2 * i, "Some words first\n\n" + "\n".join(lines)), (2 * i + 1, "/*\n * " + "\n * ".join(lines) + "\n */")]
    rows += [(1000, " filler".join(licenses.TEMPLATES[0][0].split(" ")))]
    got = {r["doc_id"]: r for r in licenses.license_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (_, label, _) in enumerate(licenses.TEMPLATES):
        for r in (got[2 * i], got[2 * i + 1]):
            assert label in r["labels"].split(",") and r["score"] == 1.0
    assert got[1000]["labels"] == ""


def test_notices_have_their_own_labels_only(spark):
    """Expected labels by hand; a template is not met without the words that tell it from others."""
    want = {
        "Licensed under the Apache License, Version 2.0.": "apache",
        "Licensed under the GNU General Public License.": "gpl",
        "Released under the MIT License.": "mit",
        "licensed under the\nMIT license": "mit",
        "Licensed under CC BY 4.0": "cc-by",
        "Licensed under the Mozilla Public License": "mpl",
        "It was released under the new license of the town.": "",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license": "",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:": "bsd",
        "This is free and unencumbered software\nreleased into the public domain.": "unlicense",
        "All rights reserved.": "reserved",
    }
    rows = list(enumerate(want))
    got = {r["doc_id"]: r["labels"] for r in licenses.license_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {text: got[i] for i, text in rows} == want


def test_blocks_by_brute_force():
    draw = random.Random(8)
    for _ in range(300):
        ranks = [draw.choice((-1, -1, 0, 1, 2, 3, 4)) for _ in range(draw.randrange(40))]
        own, heads, names, size, least = {0, 1, 2, 3, 4}, {0, 1}, {3}, draw.randrange(1, 9), 4
        runs = [set(ranks[i : i + size]) & own for i in range(len(ranks))]
        best = max((len(r) for r in runs if len(r) >= least and names <= r), default=0)
        got = licenses.candidate_blocks(ranks, own, heads, names, size, least)
        assert max(map(len, got), default=0) == best and {*map(frozenset, got)} <= {*map(frozenset, runs)}


def test_template_language():
    run = templates.compile_template("{% set x = 'a' + 'b' %}{% for m in ms %}{% if loop.first %}{{ x }}{% elif m.k == 2 and not loop.last %}two{% else %}{{ m['k'] }}{% endif %}{% endfor %}{% if 'a' == 'b' %}no{% endif %}")
    assert "".join(t for t, _ in run(ms=[{"k": 1}, {"k": 2}, {"k": 2}])) == "abtwo2"
    tree = templates.fold(templates.parse("a{{ 'b' + 'c' | upper }}{% if true %}d{% endif %}{{ x }}", {"upper": None}), templates.OPERATORS)
    assert len(tree) == 2 or tree[0].value.value.startswith("abC")
    for bad in ("{{ x.__class__ }}", "{{ x() }}", "{% for x in %}", "{% if a %}", "{{ 'a }}"):
        with pytest.raises(templates.TemplateError):
            list(templates.compile_template(bad)(x="s", a=1))


def test_escapes_are_reversible():
    for text in ("<|im_end|>", "<\\|", "<\\\\|a", "<", "|", "<<||", "a\\nb"):
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        assert chat.unescape_role(chat.escape_role(text + "\n")) == text + "\n"


def test_pages():
    page = '<html><head><title>t</title></head><body class="no-nav"><div class="menu">m</div><div class="wrap7"><div id="c">One&nbsp;&amp; <i>two</i><br>three<p>four<script>"</p>"</script><ul><li>five<li>six</ul><!-- x --></div></div><div class="comments">no</div><aside>s</aside><form>f</form>'
    assert webpages.extract(page, []) == "One & two three\nfour\nfive\nsix"
    assert webpages.extract(page, ["/html/body/div.wrap#"]) == "One & two three\nfour\nfive\nsix"
    assert webpages.extract("", ["/x"]) == "" and webpages.extract("<p", []) == "" and webpages.extract("a < b", []) == "a < b"


def test_an_article_keeps_what_stands_beside_its_body():
    body = "<p>" + "body text " * 40 + "</p>"
    text = ("body text " * 40).strip()
    for inner in ("div class='entry-content'", "section"):
        wrapped = f"<h1>T</h1><p>lede</p><{inner}>{body}</{inner.split()[0]}><p>end</p>"
        for outer in ("article", "main", "div class='post'", "div"):
            page = f"<body><div class='x'>stray</div><{outer}>{wrapped}</{outer.split()[0]}></body>"
            assert webpages.extract(page, []) == f"T\nlede\n{text}\nend"
    page = f"<body><h1>Site</h1><main><p>note</p><article><h2>T</h2><div class='text'>{body}</div><p>end</p></article></main></body>"
    assert webpages.extract(page, []) == f"note\nT\n{text}\nend"
    assert webpages.extract(f"<body><h1>T</h1><article>{body}</article></body>", []) == f"T\n{text}"


def test_host_votes_outweigh_a_page(spark):
    body = "<body><div class='a'>%s</div><div class='b'>%s</div></body>"
    pages = [(i, f"http://h/{i}", body % ("long text " * 30, "x")) for i in range(9)] + [(9, "http://h/9", body % ("short", "other words " * 30))]
    got = {r["page_id"]: r["text"] for r in webpages.extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[9] == "short" and got[0] == ("long text " * 30).strip()


def test_the_vote_of_a_host_by_known_main_texts(spark, monkeypatch):
    """Two layouts a host, without articles; on some pages other text is longer, so that only the host's vote finds the main text."""
    draw = random.Random(9)
    words = lambda n: " ".join(draw.choice(("stone", "river", "lamp", "road", "winter", "table", "green")) for _ in range(n))
    pages, want = [], {}
    for h in range(4):
        for k in range(24):
            i = 100 * h + k
            short = k % 6 == 5
            paragraphs = [words(draw.randrange(2, 5) if short else draw.randrange(30, 90)) for _ in range(1 if short else 3)]
            other = words(60 if short else 4)
            main = "".join(f"<p>{p}</p>" for p in paragraphs)
            if k % 2:
                html = f"<body><div class='top n{k}'>{words(2)}</div><div class='page h{h}'><div class='col'>{main}</div><div class='extra x{k}'>{other}</div></div></body>"
            else:
                html = f"<body><table><tr><td class='left'>{words(3)}</td><td class='mid h{h}'>{main}</td><td class='right'>{other}</td></tr></table></body>"
            pages.append((i, f"http://host{h}.example/{i}", html))
            want[i] = "\n".join(paragraphs)
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in webpages.extract_pages(table).collect()}
    alone = {i: webpages.extract(html, []) for i, _, html in pages}
    assert got == want
    monkeypatch.setattr(webpages, "SENT_BYTES", -1)  # winners are joined by host and salt in place of being sent
    assert {r["page_id"]: r["text"] for r in webpages.extract_pages(table).collect()} == want
    assert sum(alone[i] != want[i] for i in want) >= 8


def test_deep_markup_takes_linear_time_and_memory():
    began, sizes = time.time(), []
    for n in (10_000, 100_000):
        page = webpages.parse("<div class='a1'>" * n + "<i>" * n + "text" + "</b>" * n + "</i>" * n + "</div>" * n)
        sizes.append(len(page.paths))
        assert page.path(len(page.containers) - 1).count("/") == n and webpages.text_of(page, page.path(5)) == "text"
    assert sizes == [10_000, 100_000] and time.time() - began < 60


def test_arrivals_and_tiers_by_hand(spark, tmp_path):
    """Arrivals of one pass are versions of their own; what is merged is what plain counting says, and no row is lost."""
    rows = spark.range(1000).select("id", F.md5(F.col("id").cast("string")).alias("_arrival"))
    store = shards.ShardStore(spark, str(tmp_path), target_bytes=1 << 20)
    assert store.append_each(rows, F.col("id") % 5) == 5
    for v in range(1, 6):
        assert sorted(r["id"] for r in store.read(v).collect()) == [i for i in range(1000) if i % 5 < v]
    assert store.read().columns == ["id", "_arrival", "_shard", "_shard_bytes", "_version"]
    names = ["a", "b", "c", "d", "e", "f", "g", "h", "i"]
    made = [shards.Shard(n, b) for n, b in zip(names, (10, 12, 39, 40, 41, 44, 50, 60, 600_000), strict=True)]
    assert [[s.path for s in run] for run in store.plan(made)] == [["a", "b", "c", "d"], ["e", "f", "g", "h"]]
    version = store.compact()
    assert version > 5 and len(store.manifest()[1]) < len(store.manifest(5)[1])
    assert sorted(r["id"] for r in store.read().collect()) == sorted(r["id"] for r in store.read(5).collect()) == list(range(1000))


def test_compaction_keeps_all_rows_and_versions(spark, tmp_path):
    store = shards.ShardStore(spark, str(tmp_path), target_bytes=40_000)
    for k in range(5):
        store.append(spark.range(k * 1000, k * 1000 + 1000, numPartitions=2).withColumn("_shard", F.md5(F.col("id").cast("string"))))
    version, before = store.manifest()
    assert version == 5 and len(before) == 10
    after = store.manifest(store.compact())[1]
    assert len(after) < len(before)
    assert sorted(r["id"] for r in store.read().collect()) == sorted(r["id"] for r in store.read(5).collect()) == list(range(5000))
    with pytest.raises(shards.ManifestConflict):
        store._commit(3, store.segments()[1])
    store.vacuum()
    assert {s.path for s in store._files(f"{tmp_path}/data")} == {s.path for s in after}


def test_commits_write_their_own_segments(spark, tmp_path):
    """A store of many shards: a commit lists what it adds, and takes the others by the names of their lists."""
    store = shards.ShardStore(spark, str(tmp_path))
    many = [shards.Shard(f"file:/none/data/x/{i}", shards.TARGET_BYTES) for i in range(100_000)]
    assert store._arrived(store._segment("x", many)) == 1
    lists = {f: f.stat().st_mtime_ns for f in (tmp_path / "segments").glob("*.json")}
    for k in range(3):
        store.append(spark.range(k * 10, k * 10 + 10, numPartitions=2))
    now = {f: f.stat().st_mtime_ns for f in (tmp_path / "segments").glob("*.json")}
    assert len(now) == 4 and lists.items() <= now.items()
    assert sum(f.stat().st_size for f in now if f not in lists) < 2000 and (tmp_path / "manifests" / "v000000004.json").stat().st_size < 2000
    assert store.shards().count() == 100_006 and store.shards(1).agg(F.sum("bytes")).first()[0] == 100_000 * shards.TARGET_BYTES
    looked, listed = [], store._listed
    store._listed = lambda g: looked.extend(g := list(g)) or listed(g)
    assert store.compact() == 5 and {g.shards for g in looked} <= {1, 2}  # the list of large shards isn't read
    assert max(g.shards for g in store.segments()[1]) == 100_000
    assert store.shards().count() == 100_001


def test_locations_are_those_of_the_files(spark, tmp_path):
    """Shard, bytes and version of the rows against the files of the store, before and after some shards of a write are merged."""
    store = shards.ShardStore(spark, str(tmp_path), target_bytes=60_000)
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.when(F.col("id") < 400, 40).otherwise(1)), lambda i: F.md5(F.concat(F.col("id").cast("string"), i.cast("string")))), "")
    store.append(spark.range(0, 800, numPartitions=8).withColumn("t", text))  # half of the shards are large
    store.append_each(spark.range(800, 900, numPartitions=2).withColumn("t", text), F.col("id") % 2)
    for step in range(2):
        rows = store.read().collect()
        version, live = store.manifest()
        sizes = {f"{p.relative_to(tmp_path / 'data')}": p.stat().st_size for p in (tmp_path / "data").rglob("*.parquet")}
        assert sorted(r["id"] for r in rows) == list(range(900)) and {r["_version"] for r in rows} == {version} == {max(store.versions())}
        assert {r["_shard"] for r in rows} == {s.path.partition("/data/")[2] for s in live}
        assert all(sizes[r["_shard"]] == r["_shard_bytes"] for r in rows)
        assert sorted((s.path, s.bytes) for s in live) == sorted(map(tuple, store.shards().collect()))
        if not step:
            store.compact()
            assert any(not g.whole for g in store.segments()[1])
            old = store.read(version).count()
            store.vacuum()
            assert old == 900
            left = {s.path for s in store._files(f"{tmp_path}/data")}
            assert left == {s.path for s in store.manifest()[1]}
            assert {p.name for p in (tmp_path / "segments").glob("*.json")} == {g.name for g in store.segments()[1]}


def plain_print(text):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in words).split(" ") if w]
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash_components_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = {d["doc_id"]: plain_print(d["text"]) for d in docs}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(prints, 2):
        if bin(prints[a] ^ prints[b]).count("1") <= 2:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op10_simhash_bktree"](spark, SF).collect()}
    assert got == {i: (f"{p:016x}", find(i)) for i, p in prints.items()}


def test_large_shards_lose_no_link(spark, monkeypatch):
    """Fingerprints that all share a mask are dealt by finer masks, then in pairs of parts, and give the same groups."""
    draw = random.Random(3)
    prints = list({draw.getrandbits(20) for _ in range(1500)})
    points = spark.createDataFrame([(p, p) for p in prints], "id long, fp0 long")
    roots = []
    for most, finer in ((10**9, None), (40, None), (40, simhash.exact_masks(2)[1])):
        monkeypatch.setattr(simhash, "SHARD_ROWS", most)
        links = simhash.near_links(points, 1, 2, simhash.exact_masks(2)[0], finer)
        roots.append(sorted(tuple(r) for r in simhash.components(links).collect()))
    assert len(roots[0]) > 100 and roots[0] == roots[1] == roots[2]


def test_near_copies_leave_one_and_others_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sets, places = {}, defaultdict(list)
    for d in docs.collect():
        words = d["text"].lower().split()
        sets[d["doc_id"]] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
        for s in sets[d["doc_id"]]:
            places[s].append(d["doc_id"])
    pairs = {p for ids in places.values() for p in itertools.combinations(sorted(ids), 2)}
    likeness = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in pairs}
    kept = {r["doc_id"] for r in simhash.drop_near_copies(docs).select("doc_id").collect()}
    near = {p for p, s in likeness.items() if s >= 0.8}
    both = {p for p in near if set(p) <= kept}
    assert len(both) <= 0.05 * len(near)
    alone = {i for i in sets if not any(i in p for p, s in likeness.items() if s >= 0.5)}
    assert len(alone - kept) <= 0.002 * len(alone)


def test_near_copies_are_settled_by_their_shingles(spark, monkeypatch):
    """Pairs of a similarity of 0.82 leave one, pairs of 0.78 stay, whatever their fingerprints; in parts of groups, too."""
    draw = random.Random(5)
    rows, want = [], set()
    for k in range(80):
        words = [f"w{draw.randrange(10**6)}" for _ in range(205)]
        changed = list(words)
        for i in draw.sample(range(5, 40), 4 + k % 2):
            changed[5 * i - 1] = f"x{draw.randrange(10**6)}"
        sets = [{tuple(x[i : i + 5]) for i in range(201)} for x in (words, changed)]
        near = len(sets[0] & sets[1]) / len(sets[0] | sets[1]) >= 0.8
        assert near == (k % 2 == 0)
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(changed))]
        want |= {2 * k} if near else {2 * k, 2 * k + 1}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in simhash.drop_near_copies(docs).collect()} == want
    monkeypatch.setattr(simhash, "GROUP_ROWS", 1)
    assert {r["doc_id"] for r in simhash.drop_near_copies(docs).collect()} == want


def planted_pairs(draw, low, high, count):
    """Pairs of texts whose five-word shingle sets have a similarity between ``low`` and ``high``, by changes of single words."""
    out = []
    while len(out) < count:
        words = [f"w{draw.randrange(10**6)}" for _ in range(draw.randrange(60, 400))]
        changed = list(words)
        share = draw.uniform(low, high)
        for i in draw.sample(range(len(words)), max(1, round((1 - share) / (1 + share) * len(words) / 5))):
            changed[i] = f"x{draw.randrange(10**6)}"
        sets = [{tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (words, changed)]
        if low <= len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < high:
            out.append((" ".join(words), " ".join(changed)))
    return out


def test_recall_of_planted_pairs_by_similarity(spark):
    """At least 300 pairs for each band of similarity; below 0.8 none is to go, from 0.8 on nine of ten and in the exact mode all."""
    draw = random.Random(11)
    bands = [(0.75, 0.8), (0.8, 0.82), (0.82, 0.86), (0.86, 0.9), (0.9, 0.96)]
    pairs = [(k, p) for k, (low, high) in enumerate(bands) for p in planted_pairs(draw, low, high, 300)]
    rows = [(2 * i + j, text) for i, (_, pair) in enumerate(pairs) for j, text in enumerate(pair)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for way in ({}, {"bits": 16}, {"exact": True}):
        kept = {r["doc_id"] for r in simhash.drop_near_copies(docs, **way).select("doc_id").collect()}
        assert {2 * i for i in range(len(pairs))} <= kept
        found = [0] * len(bands)
        for i, (k, _) in enumerate(pairs):
            found[k] += 2 * i + 1 not in kept
        print(way, dict(zip(bands, (n / 300 for n in found), strict=True)))
        assert found[0] == 0 and min(found[1:]) >= (300 if way.get("exact") else 290)


def test_shards_stay_small_in_a_corpus_of_any_size():
    assert [simhash.bits_for(n) for n in (0, 10**5, 4 * 10**6, 10**7, 5 * 10**10)] == [12, 12, 12, 14, 26]
    tables = {bits: simhash.sampled_bits(4, bits) for bits in (12, 16, 20)}
    assert [len(tables[b]) for b in tables] == [48, 107, 235]
    for bits, masks in tables.items():
        assert all(sum(m.bit_count() for m in mask) == bits for mask in masks)
        assert 0.004 < (1 - (1 - 45 / 256) ** bits) ** len(masks) <= 0.007


def test_exact_links_by_all_pairs(spark, monkeypatch):
    """Small texts of few words, so that sets of all sizes and overlaps occur, chains and texts without words among them.

    Groups are compared whole, and by prefixes of their ordered shingles.
    """
    draw = random.Random(12)
    texts = list({" ".join(draw.choice("ab") for _ in range(draw.choice((2, 4, 5, 9, 25, 50, 70)))) for _ in range(250)}) + ["", " ", None]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string")
    words = [(x or "").split() for x in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            x, y = sorted((find(i), find(j)))
            root[y] = x
    want = {i for i in range(len(texts)) if find(i) == i}
    assert {r["doc_id"] for r in simhash.drop_near_copies(docs, exact=True).collect()} == want and len(want) < len(texts) - 20
    for most in (20, 3):
        monkeypatch.setattr(simhash, "GROUP_ROWS", most)
        assert {r["doc_id"] for r in simhash.drop_near_copies(docs, exact=True).collect()} == want


def test_a_large_group_is_linked_whole_however_it_is_dealt(spark, monkeypatch):
    """A group whose texts change bit by bit, so that the ends aren't alike: one component, however it is dealt."""
    draw = random.Random(13)
    words, rows = [f"w{draw.randrange(10**6)}" for _ in range(100)], []
    for i in range(60):
        words[draw.randrange(100)] = f"y{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, root long")
    members = docs.select("root", "doc_id", simhash.text_hash(F.col("text")).alias("text_hash"))
    sets = [{tuple(x.split()[i : i + 5]) for i in range(96)} for _, x in rows]
    assert 5 * len(sets[0] & sets[59]) < 4 * len(sets[0] | sets[59])
    for most in (1000, 7, 1):
        monkeypatch.setattr(simhash, "GROUP_ROWS", most)
        links = simhash.similar_links(docs, members, 5)
        assert {r["root"] for r in simhash.components(links).collect()} == {members.agg(F.min("text_hash")).first()[0]}
        assert simhash.components(links).count() == 60


@pytest.mark.parametrize("share", [0.6, 0.74, 0.9])
def test_boilerplate_is_compared_in_proportion(spark, monkeypatch, share):
    """Texts of one boilerplate, below the bound or above it: pairs compared grow with the texts, not with their square."""
    draw, per_row, linked = random.Random(15), [], []
    own = round(200 * (1 - share) / (1 + share))  # words of its own at the end of each text
    made = []
    alike = simhash._alike
    monkeypatch.setattr(simhash, "_alike", lambda pairs, sets, share: made.append(pairs.count()) or alike(pairs, sets, share))
    common = " ".join(f"w{i}" for i in range(200 - own + 4))
    for n in (1500, 6000):
        made.clear()
        rows = [(i, f"{common} " + " ".join(f"x{draw.randrange(10**9)}" for _ in range(own))) for i in range(n)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        members = docs.select(F.lit(1).cast("long").alias("root"), "doc_id", simhash.text_hash(F.col("text")).alias("text_hash"))
        linked.append(simhash.components(simhash.similar_links(docs, members, 5)).count())
        per_row.append(sum(made) / n)
    assert linked == ([0, 0] if share < 0.8 else [1500, 6000])
    assert per_row[1] <= max(2 * per_row[0], 0.1) and per_row[1] < 4
