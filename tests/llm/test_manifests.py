"""Repeated lines, whitening and the Merkle manifest against their SQL, brute force, and odd tables."""

import hashlib
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import linededup, merkle, whitening
from corpusloom.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _keep binary, tree string"
sha = lambda x: hashlib.sha256(x.encode()).hexdigest()


def line_rows(docs, least_chars=40, least_docs=5):
    """(doc_id, n_lines, n_dropped, kept text) of each row, by plain sets."""
    key = lambda x: x.strip(" \t\n\v\f\r").translate({i: i + 32 for i in range(65, 91)})
    holders = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc)
    shared = {k: max(h, key=lambda d: (d is not None, d)) for k, h in holders.items() if len(k) >= least_chars and len(h) >= least_docs}
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in shared or shared[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def random_docs(seed, n):
    draw = random.Random(seed)
    pool = [f"{'  Line ' * draw.randrange(1, 4)}number {i} of a text that several documents hold" for i in range(12)] + ["", "short", "é" * 39, "É" * 40]
    pool += ["A line that nearly every document holds, in one form or the other\t"] * 6
    docs = []
    for i in range(n):
        lines = [draw.choice((str.upper, str.lower, str))(draw.choice(pool)) for _ in range(draw.randrange(6))]
        docs.append((draw.choice((i, i, i, None, 3)), None if i % 17 == 0 else "\n".join(lines + [f"own {i} " * 9])))
    return docs + docs[:5]


def test_lines_by_brute_force_and_their_bitmaps(spark):
    docs = random_docs(1, 150)
    rows = spark.createDataFrame([(d, t, None, "s", 1, b"x", "y") for d, t in docs], DOCS)
    want = sorted(((str(d), t) for d, _, _, t in line_rows(docs)))
    kept = linededup.drop_repeated_lines(rows)
    assert kept.columns == rows.columns
    got = kept.collect()
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in got) == want and all(r["_keep"] == b"x" for r in got)
    assert sum(r["text"] is None for r in got) == sum(t is None for _, t in docs)
    lost = {(d, t): n for (d, t), (_, _, n, _) in zip(docs, line_rows(docs), strict=True) if n}
    maps = linededup.keep_bitmaps(rows.select("doc_id", "text")).collect()
    assert len(maps) == len(lost) and sum(r["n_dropped"] for r in maps) == sum(lost.values())
    assert all((~linededup.unpack(bytes(r["keep"]), r["n_lines"])).sum() == r["n_dropped"] for r in maps)
    looser = linededup.drop_repeated_lines(rows, least_chars=5, least_docs=2).collect()
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in looser) == sorted((str(d), t) for d, _, _, t in line_rows(docs, 5, 2))


def test_a_line_in_all_documents_lies_in_many_ranges(spark):
    line = "this very line stands in every document of the table"
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit(f"{line}\nx"), F.col("id"), F.lit(f"\n{line}")).alias("text"))
    held = linededup.line_hashes(docs)
    sizes = held.repartitionByRange(8, "h1", "h2", F.desc("doc_id")).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 8000 / 3
    maps = linededup.keep_bitmaps(docs)
    assert maps.count() == 3999 and maps.agg(F.max("doc_id"), F.sum("n_dropped")).first()[:] == (3998, 2 * 3999)


def test_runs_that_ranges_share(monkeypatch):
    draw = random.Random(5)
    for _ in range(200):
        rows = sorted(((draw.randrange(3), 0, draw.randrange(6)) for _ in range(draw.randrange(1, 40))), key=lambda r: (r[0], -r[2]))
        cuts = sorted(draw.randrange(len(rows) + 1) for _ in range(4))
        ends = []
        for part, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)], strict=True)):
            runs = []
            for h, g, doc in rows[a:b]:
                if not runs or runs[-1].key != (h, g):
                    runs.append(linededup.Run((h, g)))
                runs[-1].take(doc)
            ends += [(part, i, *r.key, r.docs, r.first, r.last) for i, r in enumerate(runs[:1] + runs[1:][-1:])]
        for part, known in linededup.shared_runs(ends).items():
            for (h, g), (docs, first) in known.items():
                own = [r[2] for r in rows if r[:2] == (h, g)]
                assert (docs, first) == (len(set(own)), max(own)), (part, rows, cuts)


def test_a_text_of_very_many_lines(spark):
    line = "a line that repeats itself over and over in a text"
    docs = [(i, f"{line}\n" * (200_000 if i == 2 else 1)) for i in range(5)]
    got = {r["doc_id"]: r for r in linededup.keep_bitmaps(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[2]["n_dropped"] == 200_000 and got[2]["n_lines"] == 200_001 and len(got[2]["keep"]) < 200 and 4 not in got


def exact_covariance(x):
    """With fractions: nothing is rounded."""
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    moved = [[n * a - s for a, s in zip(row, sums, strict=True)] for row in x]
    dims = range(len(sums))
    products = [[float(Fraction(sum(r[i] * r[j] for r in moved), n**3)) for j in dims] for i in dims]
    return np.array(products), [sum(a * a for a in r) for r in moved]


def test_whitening_by_exact_sums_and_a_library_solver(spark, monkeypatch):
    draw = np.random.default_rng(2)
    base = (draw.normal(size=(300, 40)) @ draw.normal(size=(40, 40)) * 0.1 + 3).astype(np.float32)
    rows = [(i, v.tolist(), "x") for i, v in enumerate(base)] + [(None, base[0].tolist(), "x"), (7, base[0].tolist(), "x")]
    bad = [(900, None, "x"), (901, [1.0] * 39 + [float("nan")], "x"), (902, [float("inf")] * 40, "x"), (903, [None] + [1.0] * 39, "x"), (904, [1.0], "x"), (905, [], "x"), (906, [3e38] * 40, "x")]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, deviation string")
    x = [[int(np.floor(64 * float(c))) + 1000000 for c in v] for _, v, _ in rows]
    covariance, deviations = exact_covariance(x)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    mean = np.array([float(Fraction(sum(c), len(x)) - 1000000) for c in zip(*x, strict=True)])
    want = ((np.array(x) - 1000000) - mean) @ vectors / np.sqrt(values)
    for fan, parts in ((32, 4), (2, 9)):
        monkeypatch.setattr(whitening, "FAN", fan)
        got = whitening.whitened_components(table.repartition(parts)).collect()
        assert len(got) == len(rows) * 32
        by_row = defaultdict(dict)
        for r in got:
            by_row[r["vec_id"], r["deviation"]][r["component"]] = r["whitened"]
            assert r["n"] == len(rows) and r["identity_error"] < 1e-9
            assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(covariance), rel=1e-9)
        signs = {}
        for (i, _, _), d, w in zip(rows, deviations, want, strict=True):
            own = by_row[i, d]
            assert sorted(own) == list(range(1, 33))
            for k in range(1, 33):
                sign = signs.setdefault(k, np.sign(own[k] * w[k - 1]))
                assert own[k] * sign == pytest.approx(w[k - 1], rel=1e-6, abs=1e-8)


def test_whitening_of_odd_tables(spark):
    kind = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(1, None, 1)], [(1, [1.0, 2.0], 1)], [(i, [0.5, 0.25], 1) for i in range(9)], [(1, [], 1)]):
        assert whitening.whitened_components(spark.createDataFrame(rows, kind)).collect() == []
    flat = [(i, [float(i), 2.0 * i, 1.0], 1) for i in range(5)]  # one component has variance
    got = whitening.whitened_components(spark.createDataFrame(flat, kind)).collect()
    assert [r["component"] for r in got] == [1] * 5 and got[0]["explained"] == pytest.approx(1)
    huge = [(i, [float(i) * 2**40, -float(i)], 1) for i in range(5)]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whitened_components(spark.createDataFrame(huge, kind)).collect()}
    assert got[0] == (10 * 64 * 2**40) ** 2 + (10 * 64) ** 2
    ties = [(1, [1.0, 2.0], 1), (2, [2.0, 1.0], 1), (3, [1.0], 1), (4, [2.0], 1)]
    assert {r["vec_id"] for r in whitening.whitened_components(spark.createDataFrame(ties, kind)).collect()} == {1, 2}


def test_symmetric_qr_and_parallel_merge():
    draw = np.random.default_rng(1)
    for n in (1, 2, 3, 8, 31):
        a = draw.normal(size=(n, n))
        for m in (a + a.T, a @ a.T, np.diag(np.arange(n) % 3.0), np.zeros((n, n)), np.outer(a[0], a[0])):
            values, vectors = whitening.symmetric_qr(m)
            assert np.allclose(values, np.linalg.eigvalsh(m)[::-1], atol=1e-12 * max(1, np.abs(m).max() * n))
            assert np.allclose(vectors.T @ vectors, np.eye(n), atol=1e-13) and np.allclose(m @ vectors, vectors * values, atol=1e-12 * max(1, np.abs(m).max() * n))
    x = draw.normal(size=(500, 6)) + 1e6
    parts = [whitening.Moments.empty(6) for _ in range(4)]
    for p, own in zip(parts, np.split(x, (0, 1, 200)), strict=True):
        p.add(own)
    total = parts[0].merge(parts[1]).merge(parts[2].merge(parts[3]))
    assert total.n == 500 and np.allclose(total.covariance(), np.cov(x.T, bias=True), rtol=1e-9, atol=1e-9)


def tree(leaves, run):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + run])) for i in range(0, len(levels[-1]), run)])
    return levels


def path(levels, at, run):
    out = []
    for level in levels[:-1]:
        first = at - at % run
        out.append(("".join(level[first:at]), "".join(level[at + 1 : first + run])))
        at //= run
    return out


def manifest_rows(docs, run):
    """The contract's rows by plain lists."""
    told = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda d, text: sha("".join(map(told, (d[0], d[3], d[2], d[4], text))))
    sources = defaultdict(list)
    for d in docs:
        sources[d[3]].append((d[0] is not None, d[0] or 0, leaf(d, d[1]), d))
    trees = {s: tree([x[2] for x in sorted(rows, key=lambda x: x[:3])], run) for s, rows in sources.items()}
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    top = tree([trees[s][-1][0] for s in order], run)
    out = []
    for i, s in enumerate(order):
        for at, (_, _, own, d) in enumerate(sorted(sources[s], key=lambda x: x[:3])):
            sides = path(trees[s], at, run) + path(top, i, run)
            changed = d[1]
            if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 0 and changed:
                changed = changed.translate({k: k + 32 for k in range(65, 91)})
            node = leaf(d, changed)
            for left, right in sides:
                node = sha(left + node + right)
            proof = sha("".join(a + b for a, b in sides))
            out.append((d[0], own, trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


@pytest.mark.parametrize(("run", "levels"), [(16, 2), (2, 1), (3, 2), (2, 3)])
def test_manifest_by_brute_force(spark, monkeypatch, tmp_path, run, levels):
    monkeypatch.setattr(merkle, "RUN", run)
    monkeypatch.setattr(merkle, "LEVELS", levels)
    draw = random.Random(run)
    sizes = {"b": 300, "a": 17, "é": 16, None: 5, "": 1, "B": 2, "z": 33, **{f"s{i}": 1 + i % 3 for i in range(20)}}
    docs = []
    for source, n in sizes.items():
        for _ in range(n):
            docs.append((draw.choice((None, *range(500))), draw.choice((None, "", "Text Ä é", "low", "x" * 3000 + "Y")), draw.choice((None, "en")), source, draw.choice((None, -3, 12)), b"", "t"))
    docs += docs[:7]
    spark.createDataFrame(docs, DOCS).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_merkle_manifest"](spark, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, manifest_rows(docs, run)))


def test_manifests_of_one_leaf_and_of_none(spark, tmp_path):
    one = [(1, "A", "en", "s", 1, b"", "t")]
    spark.createDataFrame(one, DOCS).write.parquet(f"{tmp_path}/one/documents.parquet")
    (row,) = QUERIES["op13_merkle_manifest"](spark, f"{tmp_path}/one").collect()
    assert row["leaf"] == row["subroot"] == row["root"] == sha("1:1" "1:s" "2:en" "1:1" "1:A") and row["proof_sha256"] == sha("")
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/none/documents.parquet")
    rows, root = merkle.manifest(spark.read.parquet(f"{tmp_path}/none/documents.parquet"))
    assert root is None and rows.count() == 0


@pytest.mark.parametrize("name", ["op11_lines_keep_bitmaps", "op13_merkle_manifest"])
def test_random_documents_are_those_of_the_sql(spark, tmp_path, name):
    docs = [(d, t, random.Random(i).choice(("en", None)), random.Random(i).choice(("a", "b", None)), i, b"", "t") for i, (d, t) in enumerate(random_docs(3, 120))]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    oracle.compare(spark, QUERIES[name], ORACLE_SQL[name], str(tmp_path))
