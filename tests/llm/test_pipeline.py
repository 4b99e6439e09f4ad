import itertools
import re
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect_and_keep_the_columns(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "sharding"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == COLUMNS and docs.count() > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.count() == docs.count() and "shard" in last.columns


CLASHING = {
    "score": "double", "lang_pred": "string", "_words": "int", "_id": "string", "_k": "int", "_plans": "string", "_kept_id": "long", "_kept_hash": "long",
    "_lettered": "int", "_text_hash": "string", "_text": "string", "_runs": "string", "_items": "int", "_parts": "string", "_passes": "string",
    "_picked": "int", "_whole": "string", "_number": "string", "_shard": "string", "_arrival": "int", "key": "string", "size": "int", "root": "string", "a.b": "int",
}


def odd_table(spark):
    """The odd rows with all names that the operators use themselves, and with a name that has a dot."""
    from test_operators import DOCS, ODD

    docs = spark.createDataFrame(ODD, DOCS)
    values = {"double": 0.5, "string": "v", "int": 7, "long": 8}
    return docs.select("*", *(F.lit(values[t]).cast(t).alias(n) for n, t in CLASHING.items()))


def rows_of(df, *skip):
    return sorted((tuple(v for k, v in r.asDict().items() if k not in skip) for r in df.collect()), key=str)


def test_odd_rows_and_clashing_columns_in_each_stage(spark, tmp_path):
    """Rows and columns of each stage, collected whole, as they are expected by hand."""
    sf = str(tmp_path)
    odd_table(spark).write.parquet(f"{sf}/documents.parquet")
    items = [(1, "hidden hello there the"), (2, None), (None, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    by = {name: stage(spark, docs, sf) for name, stage in corpus_pipeline.STAGES[:-1]}
    assert all(df.columns == docs.columns and df.schema.simpleString() == docs.schema.simpleString() for df in by.values())
    every = rows_of(docs)
    long_text = "Hello there, the secret = abc123456 is hidden " * 3000
    assert rows_of(by["language_id"]) == [r for r in every if r[1] and any(c.isalpha() for c in r[1])]
    # A null text, an empty one and its copy have no words and are one group; so are rows of equal text.
    assert rows_of(by["near_dedup"], "source", "n_chars") == [r for r in rows_of(docs.filter("doc_id IS NULL OR doc_id IN (1, 3, 4)"), "source", "n_chars")]
    cut = {r["doc_id"]: r for r in by["decontamination"].collect()}
    assert rows_of(by["decontamination"].filter("coalesce(doc_id, 0) <> 3")) == rows_of(docs.filter("coalesce(doc_id, 0) <> 3"))
    left = cut[3]["text"]
    assert left.count("hidden") == 1 and len(left) < len(long_text) and cut[3]["n_chars"] == len(left)
    mixed = by["mixing"].collect()
    assert {r["doc_id"] for r in mixed} == {3, None, 4} and all(r["a.b"] == 7 and r["_plans"] == "v" and r["score"] == 0.5 for r in mixed)
    assert sum(r["text"] == "tiny" for r in mixed) == 3  # a source of one word takes three times its words
    last = corpus_pipeline.sharding(spark, docs, sf)
    assert rows_of(last.select(*(f"`{c}`" for c in docs.columns if c != "_shard"))) == rows_of(docs.drop("_shard"))
    assert len(corpus_pipeline.run(spark, sf).collect()) > 0
    spark.createDataFrame([], docs.schema).write.parquet(f"{sf}/none/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{sf}/none").collect() == []
    none = spark.read.parquet(f"{sf}/none/documents.parquet")
    assert all(stage(spark, none, f"{sf}/none").collect() == [] for _, stage in corpus_pipeline.STAGES)


def test_queries_take_tables_with_clashing_columns(spark, tmp_path):
    from corpusloom.llm.queries import QUERIES
    from test_operators import DOCS, ODD

    plain, odd = f"{tmp_path}/plain", f"{tmp_path}/odd"
    spark.createDataFrame(ODD, DOCS).write.parquet(f"{plain}/documents.parquet")
    odd_table(spark).write.parquet(f"{odd}/documents.parquet")
    for folder in (plain, odd):
        spark.createDataFrame([(1, "hidden hello there the")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    vectors = spark.createDataFrame([(i, [float(i * i % 7), float(i % 5), 1.5 * i]) for i in range(12)], "vec_id long, embedding array<float>")
    vectors.write.parquet(f"{plain}/embeddings.parquet")
    vectors.selectExpr("'k' AS key", "embedding", "embedding AS vector", "vec_id", "'d' AS deviation", "1 AS n").write.parquet(f"{odd}/embeddings.parquet")
    for name, query in QUERIES.items():
        if name[:4] not in ("op7_", "op8_"):
            assert rows_of(query(spark, odd), "shard", "shard_bytes") == rows_of(query(spark, plain), "shard", "shard_bytes"), name


def test_languages_are_rejected_by_chance_and_letters_kept_without_labels(spark, monkeypatch):
    from corpusloom.llm import bigru

    rows = [(i, f"some words {i}", None) for i in range(20)] + [(20, "12 !", None), (21, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r["doc_id"] for r in bigru.keep_identified(docs).collect()) == list(range(20))
    flat = {k: v * 0 for k, v in bigru._start(2).items()}
    for tilt, kept in ((0.1, 0), (2.0, 20)):
        model = flat | {"bias": flat["bias"] + [0, tilt]}
        monkeypatch.setattr(bigru, "learn", lambda _, m=model: (["a", "b"], {k: v.astype("float32") for k, v in m.items()}))
        assert bigru.keep_identified(docs).count() == kept


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_dedup(docs):
    """The rows of smallest doc_id of each component of texts whose five-word shingle sets have a similarity of 0.8, by all pairs."""
    words = {i: [w for w in re.split("[ \t\n\x0b\x0c\r]+", t.translate(LOWER)) if w] for i, t in docs.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(docs), 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: t for i, t in docs.items() if find(i) == i}


def plain_cut(text, windows):
    """``text`` without the characters from the first to the last word of each run of words that windows cover."""
    places = [m.span() for m in re.finditer("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.translate(LOWER))]
    words = [text[a:b].translate(LOWER) for a, b in places]
    hit = [False] * len(words)
    for n in {len(w) for w in windows}:
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit[i : i + n] = [True] * n
    out, at = "", 0
    for k, (a, b) in enumerate(places):
        if hit[k]:
            if k == 0 or not hit[k - 1]:
                out += text[at:a]
            at = b
    return out + text[at:]


def test_pipeline_by_brute_force(spark, tmp_path):
    """Each stage of a run over whole tables against plain Python, and the mix against op4's SQL over its own input."""
    from corpusloom.llm import bigru
    from corpusloom.llm.mixing import OP4_SQL

    sf = "/root/testdata/sf0.001"
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    scores = bigru.identify(docs, bigru.learn(docs.select("doc_id", "text", "lang"))).collect()
    want = {r["doc_id"]: r["text"] for r in scores if any(c.isalpha() for c in r["text"]) and r["lang_pred"] != "und" and r["score"] >= 0.3}
    docs = stages["language_id"](spark, docs, sf).cache()
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == want
    want = plain_dedup(want)
    docs = stages["near_dedup"](spark, docs, sf).cache()
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == want
    windows = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = [x for x in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", r["text"].translate(LOWER)) if x]
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    cut = {i: plain_cut(t, windows) for i, t in want.items()}
    assert any(cut[i] != want[i] for i in cut)
    docs = stages["decontamination"](spark, docs, sf).cache()
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in docs.collect()} == {i: (t, len(t)) for i, t in cut.items()}
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    taken = {i: n for i, n in con.execute(f"SELECT doc_id, taken FROM ({OP4_SQL})").fetchall() if n}
    mixed = stages["mixing"](spark, docs, sf).cache()
    given = defaultdict(int)
    for r in mixed.collect():
        given[r["doc_id"]] += len([w for w in re.split("[ \t\n\x0b\x0c\r]+", r["text"]) if w])
        assert r["text"] == cut[r["doc_id"]] or all(line in cut[r["doc_id"]] for line in r["text"].split("\n")) and r["n_chars"] == len(r["text"])
    assert given == taken
    last = stages["sharding"](spark, mixed, sf)
    assert rows_of(last.select(*COLUMNS)) == rows_of(mixed) and last.select("manifest_version").distinct().count() == 1
