"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained here, in numpy, by backpropagation through time over a bounded sample: the SAMPLE documents of
smallest hash of each language, and no more than SAMPLE * LANGUAGES in all, give LEARNED_PIECES pieces of text each; a
fifth of them are learned in capitals. Applied, every byte of a text is labelled, in pieces of PIECE bytes, and a
document's probabilities are the means over all its bytes. A unit has one gate, which keeps its state or takes the
candidate; x / (1 + |x|) stands for the sigmoid's and the hyperbolic tangent's shape, both in training and in use.

Defined cases: a null text and one without a letter are ``und`` with score 0; with nothing to learn from, every text is;
texts of any length are labelled whole, equal texts of a batch once; repeated rows each get their result; an empty table
gives no rows; other columns are kept by ``keep_identified``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import batches_of, bounded_batches, free_names, map_batches, octets, own_columns, table

#: Documents of each language, and languages, that are learned from.
SAMPLE, LANGUAGES = 500, 64
#: So many times the sample are ranked of a language with more documents; languages for which that is done.
ROOM, COUNTED = 8, 1024
#: Pieces of each document that are learned, the bytes of such a piece, and of one that is labelled.
LEARNED_PIECES, LEARNED, PIECE = 3, 96, 128
#: State of each direction.
HIDDEN = 8
EPOCHS, BATCH, RATE = 14, 200, 0.02
SEED = 42
#: Pieces that are labelled at once.
PIECES = 2048
#: Documents whose best language has less than this mean probability are rejected by ``keep_identified``.
KEPT_SCORE = 0.3
#: Likewise those with less than so many times the probability of chance, which is above KEPT_SCORE for few languages.
KEPT_CHANCE = 1.2

Model = dict[str, np.ndarray]


def soft(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _start(languages: int) -> Model:
    draw = np.random.default_rng(SEED)
    out = {}
    for side in "fb":
        out[f"in_{side}"] = draw.normal(0, 0.3, (256, 2 * HIDDEN)).astype(np.float32)
        out[f"in_{side}"][:, :HIDDEN] += 1.0  # states last at first
        out[f"rec_{side}"] = draw.normal(0, 0.3, (HIDDEN, 2 * HIDDEN)).astype(np.float32)
    out["out"] = draw.normal(0, 0.3, (2 * HIDDEN, languages)).astype(np.float32)
    out["bias"] = np.zeros(languages, dtype=np.float32)
    return out


def _forward(seq: np.ndarray, mask: np.ndarray, table_: np.ndarray, rec: np.ndarray) -> tuple[np.ndarray, list]:
    """States (time, piece, hidden) over ``seq`` (time, piece), and what the way back needs."""
    h = np.zeros((seq.shape[1], HIDDEN), dtype=np.float32)
    states, kept = np.empty((*seq.shape, HIDDEN), dtype=np.float32), []
    for t in range(len(seq)):
        sums = table_[seq[t]] + h @ rec
        z, n = 0.5 + 0.5 * soft(sums[:, :HIDDEN]), soft(sums[:, HIDDEN:])
        kept.append((h, z, n))
        h = (n + z * (h - n)) * mask[t]
        states[t] = h
    return states, kept


def _backward(seq: np.ndarray, mask: np.ndarray, rec: np.ndarray, kept: list, given: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input table and the recurrent weights, from those of the states."""
    d_rec, later = np.zeros_like(rec), np.zeros_like(given[0])
    d_sums = np.empty((*seq.shape, 2 * HIDDEN), dtype=np.float32)
    for t in reversed(range(len(seq))):
        h, z, n = kept[t]
        d = (given[t] + later) * mask[t]
        d_sums[t, :, :HIDDEN] = d * (h - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
        d_sums[t, :, HIDDEN:] = d * (1 - z) * (1 - np.abs(n)) ** 2
        d_rec += h.T @ d_sums[t]
        later = d * z + d_sums[t] @ rec.T
    flat, values = seq.ravel(), d_sums.reshape(-1, 2 * HIDDEN)
    d_table = np.stack([np.bincount(flat, v, minlength=256) for v in values.T], axis=1).astype(np.float32)
    return d_table, d_rec


def train(texts: list[bytes], labels: np.ndarray, languages: int) -> Model:
    """A model of ``languages`` classes; every byte of a text has the text's label."""
    model = _start(languages)
    seq = np.zeros((LEARNED, len(texts)), dtype=np.uint8)
    mask = np.zeros((LEARNED, len(texts), 1), dtype=np.float32)
    for k, text in enumerate(texts):
        piece = np.frombuffer(text[:LEARNED], dtype=np.uint8)
        seq[: len(piece), k], mask[: len(piece), k] = piece, 1
    first, second = {k: np.zeros_like(v) for k, v in model.items()}, {k: np.zeros_like(v) for k, v in model.items()}
    draw, step = np.random.default_rng(SEED), 0
    steps = EPOCHS * -(-len(texts) // BATCH)
    for _ in range(EPOCHS):
        order = draw.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            s, m = seq[:, own], mask[:, own]
            f, kept_f = _forward(s, m, model["in_f"], model["rec_f"])
            b, kept_b = _forward(s[::-1], m[::-1], model["in_b"], model["rec_b"])
            both = np.concatenate([f, b[::-1]], axis=2)
            p = probabilities(both @ model["out"] + model["bias"])
            p[:, np.arange(len(own)), labels[own]] -= 1
            p *= m / m.sum()
            back = p @ model["out"].T
            grad = {"out": np.einsum("tbh,tbc->hc", both, p), "bias": p.sum(axis=(0, 1))}
            grad["in_f"], grad["rec_f"] = _backward(s, m, model["rec_f"], kept_f, back[:, :, :HIDDEN])
            grad["in_b"], grad["rec_b"] = _backward(s[::-1], m[::-1], model["rec_b"], kept_b, back[::-1, :, HIDDEN:])
            step += 1
            rate = RATE * (1 - (step - 1) / steps)
            for k, g in grad.items():  # Adam
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                model[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in model.items()}


def probabilities(logits: np.ndarray) -> np.ndarray:
    logits = np.exp(logits - logits.max(axis=-1, keepdims=True))
    logits /= logits.sum(axis=-1, keepdims=True)
    return logits


def _states(seq: np.ndarray, mask: np.ndarray | None, table_: np.ndarray, rec: np.ndarray, out: np.ndarray) -> None:
    """As ``_forward``, into ``out`` (time, hidden, piece), without what only training needs.

    Rows are features, so that every operation runs along contiguous pieces.
    """
    n, rec = seq.shape[1], np.ascontiguousarray(rec.T)
    row, x, u, size = (np.empty((2 * HIDDEN, n), np.float32) for _ in range(4))
    row = row.reshape(n, 2 * HIDDEN)
    z, new = u[:HIDDEN], u[HIDDEN:]
    h = np.zeros((HIDDEN, n), np.float32)
    for t in range(len(seq)):
        np.take(table_, seq[t], axis=0, out=row, mode="clip")
        np.copyto(x, row.T)
        np.matmul(rec, h, out=u)
        u += x
        np.abs(u, out=size)
        size += 1
        u /= size
        z *= 0.5
        z += 0.5
        h -= new
        h *= z
        h += new
        if mask is not None:
            h *= mask[t]
        out[t] = h


def label_pieces(pieces: np.ndarray, sizes: np.ndarray, model: Model) -> np.ndarray:
    """(piece, language): the sums of the probabilities over the bytes of each piece; ``pieces`` (piece, byte)."""
    n, width = pieces.shape
    sums = np.zeros((n, len(model["bias"])), dtype=np.float32)
    weights = np.ascontiguousarray(model["out"].T)
    for at in range(0, n, PIECES):
        seq = np.ascontiguousarray(pieces[at : at + PIECES].T).astype(np.intp)
        size = sizes[at : at + PIECES]
        mask = None if (size == width).all() else (np.arange(width)[:, None] < size).astype(np.float32)
        both = np.empty((width, 2 * HIDDEN, len(size)), dtype=np.float32)
        _states(seq, mask, model["in_f"], model["rec_f"], both[:, :HIDDEN])
        back = None if mask is None else mask[::-1]
        _states(seq[::-1], back, model["in_b"], model["rec_b"], both[::-1, HIDDEN:])
        logits = weights @ both
        logits += model["bias"][:, None]
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        if mask is not None:
            logits *= mask[:, None, :]
        sums[at : at + PIECES] = logits.sum(axis=0).T
    return sums


def label_texts(texts: list[bytes], model: Model) -> np.ndarray:
    """(text, language): mean probabilities over all bytes of each text; texts are not empty."""
    length = np.array([len(t) for t in texts])
    many = -(-length // PIECE)
    owner = np.repeat(np.arange(len(texts)), many)
    last = np.cumsum(many) - 1
    sizes = np.full(len(owner), PIECE)
    sizes[last] = length - (many - 1) * PIECE
    flat = np.frombuffer(b"".join(t.ljust(m * PIECE, b"\0") for t, m in zip(texts, many, strict=True)), dtype=np.uint8)
    order = np.argsort(sizes != PIECE, kind="stable")  # whole pieces need no mask
    pieces = flat.reshape(-1, PIECE)
    sums = np.empty((len(owner), len(model["bias"])), dtype=np.float32)
    whole = int((sizes == PIECE).sum())
    for part in (order[:whole], order[whole:]):
        if len(part):
            sums[part] = label_pieces(pieces[part], sizes[part], model)
    return np.add.reduceat(sums, last - many + 1, axis=0) / length[:, None]


def held_out(doc_id: Column) -> Column:
    """True for documents that are never learned from."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4)) == 2


def learn(docs: DataFrame) -> tuple[list[str], Model] | None:
    """Languages and a model from the rows of ``docs`` (doc_id, text, lang) that may be learned from."""
    rows = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    key = F.xxhash64("doc_id", "text")

    def piece(k: int) -> Column:
        draw = F.xxhash64(key, F.lit(k))
        part = F.substring("text", F.pmod(draw, F.greatest(F.length("text") - LEARNED, F.lit(0)) + 1) + 1, F.lit(LEARNED))
        return F.when(F.pmod(F.shiftrightunsigned(draw, 32), F.lit(5)) == 0, F.upper(part)).otherwise(part)

    place = F.row_number().over(Window.partitionBy("lang").orderBy("key", "pieces"))

    def smallest(some: DataFrame) -> list[Row]:
        cut = some.select("lang", key.alias("key"), F.array(*map(piece, range(LEARNED_PIECES))).alias("pieces"))
        best = cut.withColumn("place", place).filter(F.col("place") <= SAMPLE)
        return best.orderBy("place", "lang").limit(SAMPLE * LANGUAGES).collect()

    # Keys are spread evenly, so those below a bound that ROOM * SAMPLE of a language's rows are expected to be under hold
    # the SAMPLE smallest, and no task ranks more than about these. Where they don't, as few texts have a letter, all are
    # ranked; so are those of the languages that come after the first COUNTED.
    able = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    counts = able.groupBy(F.col("lang").alias("l")).agg(F.count("*").alias("n")).filter(F.col("n") > ROOM * SAMPLE)
    counts = counts.orderBy(F.desc("n"), "l").limit(COUNTED).collect()
    if not counts:
        best = smallest(rows)
    else:
        many = F.broadcast(docs.sparkSession.createDataFrame([(r["l"], float(ROOM * SAMPLE) / r["n"]) for r in counts], "l string, share double"))
        below = key < F.col("share") * 2.0**64 - 2.0**63
        best = smallest(rows.join(many, F.col("lang") == F.col("l"), "left").filter(F.col("share").isNull() | below))
        found = Counter(r["lang"] for r in best)
        if len(best) < SAMPLE * LANGUAGES and any(found[r["l"]] < SAMPLE for r in counts):
            best = smallest(rows)
    known = sorted((r["lang"], r["key"], p.encode()) for r in best for p in r["pieces"] if p)
    if not known:
        return None
    langs = sorted({x[0] for x in known})
    return langs, train([x[2] for x in known], np.array([langs.index(x[0]) for x in known]), len(langs))


def identify(docs: DataFrame, learned: tuple[list[str], Model] | None, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` (with a column text) with the columns ``pred`` and ``score``, which it doesn't have yet."""
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            raw = [t if ok else None for t, ok in zip(octets(batch.column(at)), batch.column(batch.num_columns - 1).to_pylist(), strict=True)]
            names, scores = ["und"] * len(raw), [0.0] * len(raw)
            texts = list(dict.fromkeys(t for t in raw if t))
            if texts and shared.value is not None:
                langs, model = shared.value
                p = label_texts(texts, model)
                best = {t: (langs[i], float(s)) for t, i, s in zip(texts, p.argmax(axis=1), p.max(axis=1), strict=True)}
                for k, t in enumerate(raw):
                    if t:
                        names[k], scores[k] = best[t][0], min(1.0, best[t][1])
            columns = [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], pred, score])

    bounded_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())])
    (lettered,) = free_names(docs.columns, "_lettered")
    marked = docs.withColumn(lettered, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return map_batches(marked, run, schema)


def keep_identified(docs: DataFrame, least: float = KEPT_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is found with a mean probability of ``least``; its columns, and no others, are kept.

    With k languages the best one has 1 / k at least, so ``least`` is KEPT_CHANCE / k or more. Where no row has a language
    to learn from, or all have the same, none can be told from others: the rows with a letter are kept.
    """
    learned = learn(docs.select("doc_id", "text", "lang"))
    if learned is None or len(learned[0]) == 1:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    least = max(least, KEPT_CHANCE / len(learned[0]))
    pred, score = free_names(docs.columns, "lang_pred", "score")
    found = identify(docs, learned, pred, score)
    return found.filter((F.col(pred) != "und") & (F.col(score) >= least)).select(*own_columns(docs))


def op1_langid_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
