"""SimHash near-duplicates: fingerprints of word shingles, linked through BK-trees.

Fingerprints are made in Arrow batches. Distinct fingerprints are dealt to shards by bits that two of them must
share (or very probably share) to lie within the radius; each shard becomes a BK-tree whose children are keyed by
their integer Hamming distance to the parent, and a search follows only the edges within the radius. The trees of
all shards would grow with the corpus if they were broadcast, so a shuffle brings each tree and its queries together
instead. Each shard returns a star for every group it has found, never all pairs, and the stars are joined by
distributed connected components.

Defined cases: a null text has no words; no words give fingerprint zero, which is linked like any other; a text of
fewer words than a shingle is one shingle; texts of any length are hashed whole; repeated rows keep their number; a
null doc_id never becomes a component_id unless its whole component has none; other columns are ignored, and kept as they
are, whatever their names, by ``drop_near_copies``. Texts are told apart by hashes of 64 bits there.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import batches_of, bounded_batches, durable, free_names, octets, own_columns, table
from corpusloom.llm.components import components, local_roots

SEED = 42
_SPREAD = np.uint64(0x0101010101010101)
#: Fingerprints of a shard beyond which it is dealt anew by more shared bits, and then in pairs of parts.
SHARD_ROWS = 20_000
#: Pairs of a query and a tree node that are compared at once.
FRONTIER = 1 << 20
#: Bits that a shard of the near-duplicate stage shares at least, and fingerprints beyond which it shares more.
LEAST_BITS, SHARD_POINTS = 12, 1024
#: Share of bits in which two texts may differ so that they are missed with a chance of MISSED only.
DIFFER, MISSED = 45 / 256, 0.007
#: Texts whose shingle sets share so much of their union, 4 / 5, are near-duplicates.
SIMILAR = (4, 5)
#: Texts of a group, and their bytes, beyond which it is dealt in parts, and texts of it that put its shingles in order.
GROUP_ROWS, GROUP_BYTES, SAMPLE = 1_000, 16 << 20, 64


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    """The XXH64 (seed 42) of every shingle of ``width`` words, repeats included."""
    words = text.lower().split() if text else []  # bytes: lower() and split() know ASCII letters and white space only
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], dtype=np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    n = len(words) - width + 1
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64, count=n)


def _lane(hashes: np.ndarray, lane: int) -> np.ndarray:
    """Lane 0 is the hash itself; others are mixed from it."""
    if not lane:
        return hashes
    x = hashes + np.uint64((0x9E3779B97F4A7C15 * lane) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For consecutive runs of ``sizes`` hashes, the bits set in over half of each run; an empty run gives zero."""
    out = np.zeros(len(sizes), dtype=np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    sizes = sizes[full]
    pieces = -(-sizes // 255)  # a byte counts up to 255 hashes
    first = np.cumsum(sizes) - sizes
    head = np.cumsum(pieces) - pieces
    starts = np.repeat(first, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(head, pieces))
    half = sizes[:, None]
    for k in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(k)) & _SPREAD, starts)
        counts = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), head, axis=0)
        bits = (counts * 2 > half).astype(np.uint64)
        for byte in range(8):
            out[full] |= bits[:, byte] << np.uint64(8 * byte + k)
    return out


def fingerprint_texts(texts: list[bytes | None], width: int, lanes: int) -> np.ndarray:
    """(texts, lanes) fingerprints of 64 bits a lane."""
    out = np.zeros((len(texts), lanes), dtype=np.uint64)
    at = 0
    while at < len(texts):
        end, room, runs = at, 4 << 20, []
        while end < len(texts) and (room > 0 or end == at):
            room -= len(texts[end] or b"")
            runs.append(shingle_hashes(texts[end], width))
            end += 1
        sizes, hashes = np.array([len(x) for x in runs]), np.concatenate(runs)
        for lane in range(lanes):
            out[at:end, lane] = majority(_lane(hashes, lane), sizes)
        at = end
    return out


def text_hash(text: Column) -> Column:
    """XXH64 (seed 42) of a text, which Spark and ``fingerprints`` give alike; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fingerprints(docs: DataFrame, width: int = 5, lanes: int = 1) -> DataFrame:
    """(doc_id, text_hash, fp0..) of each row of ``docs`` (doc_id, text); one bigint of bits per lane."""
    names = [f"fp{i}" for i in range(lanes)]
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), *((n, pa.int64()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            texts = octets(batch.column(1))
            made = fingerprint_texts(texts, width, lanes).view(np.int64)
            same = np.fromiter((xxhash.xxh64_intdigest(x or b"", SEED) for x in texts), dtype=np.uint64).view(np.int64)
            columns = [batch.column(0), pa.array(same), *(pa.array(made[:, i]) for i in range(lanes))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    bounded_batches(docs.sparkSession)
    ddl = ", ".join(f"{n} bigint" for n in ("doc_id", "text_hash", *names))
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(run, ddl)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


def bk_forest(points: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, ...]:
    """BK-trees of all shards at once: (root of each point's shard, parents, edge distances, children), edges sorted.

    Level by level, the first point of each open bucket becomes a node and deals the others of its bucket to
    child buckets by their distance to it.
    """
    n = len(points)
    roots = np.searchsorted(shard, shard, side="left")  # shard is sorted
    parents, keys, children = [], [], []
    node = roots.copy()
    rest = np.flatnonzero(node != np.arange(n))
    node = node[rest]
    while len(rest):
        distance = _distance(points[rest], points[node])
        order = np.lexsort((rest, distance, node))
        rest, node, distance = rest[order], node[order], distance[order]
        new = np.r_[True, (node[1:] != node[:-1]) | (distance[1:] != distance[:-1])]
        first = rest[new]
        parents.append(node[new])
        keys.append(distance[new])
        children.append(first)
        node = first[np.cumsum(new) - 1]
        rest, node = rest[~new], node[~new]
    if not parents:
        empty = np.zeros(0, dtype=np.int64)
        return roots, empty, empty, empty
    parent, key, child = map(np.concatenate, (parents, keys, children))
    order = np.lexsort((key, parent))
    return roots, parent[order], key[order], child[order]


def bk_links(points: np.ndarray, shard: np.ndarray, radius: int) -> np.ndarray:
    """The smallest member of each point's group, where points of one shard within ``radius`` are linked."""
    n, span = len(points), 64 * points.shape[1] + 1
    roots, parent, key, child = bk_forest(points, shard)
    edge = parent * span + key
    found = np.arange(n)
    stack = [(np.arange(a, min(a + FRONTIER, n)), roots[a : a + FRONTIER]) for a in range(0, n, FRONTIER)]
    while stack:
        query, node = stack.pop()
        if len(query) > FRONTIER:
            half = len(query) // 2
            stack += [(query[:half], node[:half]), (query[half:], node[half:])]
            continue
        distance = _distance(points[query], points[node])
        near = (distance <= radius) & (query != node)
        if near.any():
            found = local_roots(n, query[near], node[near], found)
        low = np.searchsorted(edge, node * span + np.maximum(distance - radius, 0), side="left")
        high = np.searchsorted(edge, node * span + np.minimum(distance + radius, span - 1), side="right")
        many = high - low
        total = int(many.sum())
        if total:
            at = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(total)
            stack.append((np.repeat(query, many), child[at]))
    return found


def shared_blocks(blocks: int, differ: int, low: int = 0, bits: int = 64) -> list[int]:
    """Masks of which fingerprints within ``differ`` bits share one: all but ``differ`` of ``blocks`` bit blocks.

    ``low`` and ``bits`` give the range of bits that is cut to blocks.
    """
    cuts = [low + bits * i // blocks for i in range(blocks + 1)]
    each = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(x) for x in combinations(each, blocks - differ)]


def bits_for(points: int) -> int:
    """Bits that a shard shares: so many more than LEAST_BITS that a shard has about SHARD_POINTS of ``points`` fingerprints, or fewer."""
    return max(LEAST_BITS, math.ceil(math.log2(max(points, 1) / SHARD_POINTS)))


def sampled_bits(lanes: int, bits: int) -> list[list[int]]:
    """Seeded bit samples: for each table a mask for every lane, ``bits`` bits in all.

    There are as many tables as it takes for two fingerprints that differ in DIFFER of 256 bits to meet in one with a chance of
    1 - MISSED, whatever ``bits`` is: 48 for 12 bits, 107 for 16, 235 for 20.
    """
    tables = math.ceil(math.log(MISSED) / math.log1p(-((1 - DIFFER) ** bits)))
    draw, out = random.Random(SEED), []
    for _ in range(tables):
        masks = [0] * lanes
        for i in draw.sample(range(64 * lanes), bits):
            masks[i // 64] |= 1 << i % 64
        out.append(masks)
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _links_of_shards(lanes: int, radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Maps batches sorted by (t, key, sub) to stars (id, root) of each shard's groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def stars(rows: np.ndarray) -> pa.RecordBatch:
            shard = np.r_[0, np.cumsum((rows[1:, :3] != rows[:-1, :3]).any(axis=1))]
            size = np.bincount(shard)
            rows = rows[size[shard] > 1]
            if not len(rows):
                root = ids = np.zeros(0, dtype=np.int64)
            else:
                shard = np.r_[0, np.cumsum((rows[1:, :3] != rows[:-1, :3]).any(axis=1))]
                root = bk_links(np.ascontiguousarray(rows[:, 4:]).view(np.uint64), shard, radius)
                ids = rows[:, 3]
                linked = root != np.arange(len(root))
                root, ids = ids[root[linked]], ids[linked]
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(root)], names=["a", "b"])

        for batch in batches_of(batches):
            held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1))
            if sum(map(len, held)) >= 100_000:
                rows = np.concatenate(held)
                last = (rows[:, :3] != rows[-1, :3]).any(axis=1)
                cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
                if cut:
                    yield stars(rows[:cut])
                held = [rows[cut:]]
        if held:
            yield stars(np.concatenate(held))

    return run


def near_links(points: DataFrame, lanes: int, radius: int, masks: list[list[int]], finer: list[int] | None) -> DataFrame:
    """Stars (a, b) of ids of ``points`` (id, fp0..) that link fingerprints within ``radius`` that share a mask's bits.

    A shard of over SHARD_ROWS fingerprints is dealt anew by the masks ``finer``, if given, which likewise keep every
    link; one that is still above is compared in pairs of its parts. Either way all links of a shard are found.
    """
    fps = [f"fp{i}" for i in range(lanes)]

    def key(mask: list[int]) -> F.Column:
        part = [F.col(f).bitwiseAND(F.lit(_signed(m))) for f, m in zip(fps, mask, strict=True)]
        return part[0] if lanes == 1 else F.xxhash64(*part)

    tables = F.array(*(F.struct(F.lit(i).cast("bigint").alias("t"), key(m).alias("key")) for i, m in enumerate(masks)))
    shards = points.select("id", *fps, F.explode(tables).alias("s")).select("s.t", "s.key", F.lit(0).cast("bigint").alias("sub"), "id", *fps)
    hot = _hot(shards)
    if not hot.isEmpty():
        if finer:
            again = F.array(*(F.xxhash64(F.lit(i), F.col("fp0").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(finer)))
            shards = _dealt(shards, hot, again)
            hot = _hot(shards)
        shards = _dealt(shards, hot, _pairs_of_parts(F.col("id"), F.col("rows")))
    dealt = shards.repartition("t", "key", "sub").sortWithinPartitions("t", "key", "sub", "id")
    return dealt.mapInArrow(_links_of_shards(lanes, radius), "a bigint, b bigint")


def _hot(shards: DataFrame) -> DataFrame:
    """(t, key, sub, rows) of the shards of over SHARD_ROWS fingerprints."""
    return durable(shards.groupBy("t", "key", "sub").agg(F.count("*").alias("rows")).filter(F.col("rows") > SHARD_ROWS))


def _dealt(shards: DataFrame, hot: DataFrame, subs: F.Column) -> DataFrame:
    """``shards`` whose rows in ``hot`` ones are dealt to each of ``subs``."""
    marked = shards.join(hot, ["t", "key", "sub"], "left")
    dealt = F.when(F.col("rows").isNotNull(), subs).otherwise(F.array("sub"))
    return marked.withColumn("sub", F.explode(dealt)).select(*shards.columns)


def _pairs_of_parts(id_: F.Column, rows: F.Column) -> F.Column:
    """For a shard in parts of half of SHARD_ROWS, the pairs of parts that a fingerprint's part is in.

    Any two fingerprints meet in the pair of their parts, so no link is lost, and a task never holds more than two parts.
    """
    return _pairs_of(id_, F.ceil(rows * 2 / SHARD_ROWS).cast("bigint"))


def _part(id_: F.Column, parts: F.Column) -> F.Column:
    return F.pmod(F.xxhash64(F.lit("part"), id_), parts)


def _pairs_of(id_: F.Column, parts: F.Column) -> F.Column:
    own = _part(id_, parts)
    return F.transform(F.sequence(F.lit(0).cast("bigint"), parts - 1), lambda i: F.least(i, own) * parts + F.greatest(i, own))


def exact_masks(radius: int) -> tuple[list[list[int]], list[int]]:
    """Masks that keep every link within ``radius`` bits of 64, and finer ones for hot shards."""
    return [[m] for m in shared_blocks(radius + 2, radius)], shared_blocks(2 * radius + 4, radius)


def near_groups(prints: DataFrame, lanes: int, radius: int, masks: list[list[int]], finer: list[int] | None) -> DataFrame:
    """(fp0.., component_id, keep_hash) of every distinct fingerprint of ``prints``: the smallest doc_id, and its
    smallest text_hash, of the fingerprint's component."""
    fps = [f"fp{i}" for i in range(lanes)]
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    distinct = prints.groupBy(*fps).agg(first.alias("first"))
    if lanes == 1:
        distinct = distinct.withColumn("id", F.col("fp0"))
    else:  # an id of 64 bits for a longer fingerprint; of 2^32 distinct ones, two are expected to share it
        distinct = distinct.withColumn("id", F.xxhash64(*fps))
    distinct = durable(distinct)
    stars = near_links(distinct.select("id", *fps), lanes, radius, masks, finer)
    roots = components(stars).withColumnRenamed("node", "id")
    rooted = durable(distinct.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")))
    # Written, so that the join's sides are plain shuffles, which Spark splits where a component holds very many rows.
    least = durable(rooted.groupBy("root").agg(F.min("first").alias("least")))
    return rooted.join(least, "root").select(
        *fps, F.col("least.doc_id").alias("component_id"), F.col("least.text_hash").alias("keep_hash")
    )


def simhash_components(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row: 64-bit fingerprints linked at ``radius`` or fewer differing bits.

    All links are found: the shards are those of the pigeonhole principle.
    """
    prints = durable(fingerprints(docs, width, 1))
    groups = near_groups(prints, 1, radius, *exact_masks(radius))
    return prints.join(groups, "fp0").select(
        "doc_id", F.lower(F.lpad(F.hex("fp0"), 16, "0")).alias("fingerprint"), "component_id"
    )


def similar_roots(texts: list[bytes | None], width: int, share: tuple[int, int] = SIMILAR) -> np.ndarray:
    """The smallest member of each text's group, where texts whose shingle sets have a similarity of ``share`` are linked.

    Overlaps are counted through the places of each shingle, one text against all, until a single group is left.
    """
    n, (part, whole) = len(texts), share
    sets = [np.unique(shingle_hashes(x, width)) for x in texts]
    sizes = np.array([len(x) for x in sets])
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    order = np.argsort(token, kind="stable")
    holder = np.repeat(np.arange(n), sizes)[order]
    edges = np.r_[0, np.cumsum(np.bincount(token))] if len(token) else np.zeros(1, dtype=np.int64)
    root = np.arange(n)
    for i in range(n):
        if not root.any():
            break
        own = token[ends[i] - sizes[i] : ends[i]]
        low, many = edges[own], edges[own + 1] - edges[own]
        at = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
        overlap = np.bincount(holder[at], minlength=n)
        near = (overlap * whole >= part * (sizes + sizes[i] - overlap)) & (root != root[i])  # two empty sets are alike
        if near.any():
            found = np.flatnonzero(near)
            root = local_roots(n, np.full(len(found), i), found, root)
    return root


def _links_of_groups(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Maps batches (root, sub, text_hash, text) sorted by (root, sub) to stars (a, b) of the text hashes of like texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}

        def stars() -> pa.RecordBatch:
            ids = np.array(list(held), dtype=np.int64)
            root = similar_roots(list(held.values()), width) if len(ids) > 1 else np.zeros(len(ids), dtype=np.int64)
            linked = root != np.arange(len(ids))
            return pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[root[linked]])], names=["a", "b"])

        for batch in batches_of(batches):
            rows = zip(*(batch.column(i).to_pylist() for i in range(3)), octets(batch.column(3)), strict=True)
            for root, sub, text_hash, text in rows:
                if (root, sub) != key:
                    if len(held) > 1:
                        yield stars()
                    key, held = (root, sub), {}
                held[text_hash] = text
        if len(held) > 1:
            yield stars()

    return run


def _ordered_sets(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Maps batches (root, sub, member, text_hash, text), a group's sample before its members, to (root, text_hash, n, tokens).

    Tokens are the member's shingles, those that fewer texts of the sample hold first, so that what the group has in common
    stands last. All members of a group have one order; which it is decides how much is compared, not what is found.
    """
    schema = pa.schema([("root", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int32()), ("tokens", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, known = None, [], None
        for batch in batches_of(batches):
            rows = zip(*(batch.column(i).to_pylist() for i in range(4)), octets(batch.column(4)), strict=True)
            out = []
            for root, sub, member, own, text in rows:
                if (root, sub) != key:
                    key, held, known = (root, sub), [], None
                # A text without words has one token of its own, as two empty sets are alike.
                tokens = np.unique(shingle_hashes(text, width)) if text and text.split() else np.zeros(1, dtype=np.uint64)
                if not member:
                    held.append(tokens)
                    continue
                if known is None:
                    known, counts = np.unique(np.concatenate(held), return_counts=True)
                    held = []
                at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                common = np.where(known[at] == tokens, counts[at], 0)
                out.append({"root": root, "text_hash": own, "n": len(tokens), "tokens": tokens[np.lexsort((tokens, common))].view(np.int64)})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _alike(pairs: DataFrame, sets: DataFrame, share: tuple[int, int] = SIMILAR) -> DataFrame:
    """(a, b) of the ``pairs`` (a, b) whose sets (text_hash, tokens) have a similarity of ``share``."""
    part, whole = share
    side = lambda name: sets.select(F.col("text_hash").alias(name), F.col("tokens").alias(f"tokens_{name}"))
    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return joined.filter(both * whole >= part * (F.size("tokens_a") + F.size("tokens_b") - both)).select("a", "b")


def links_in_large_groups(sets: DataFrame, share: tuple[int, int] = SIMILAR) -> DataFrame:
    """Links (a, b) that join all of ``sets`` (root, text_hash, n, tokens in the order of their root) of one root that are alike.

    Two sets of n <= m elements with a similarity of s share 2 s / (1 + s) * n or more, so one of the first elements of the smaller
    that are left after as many, and one of those of the larger after s * m. Only pairs that share such an element are compared.
    Those with the smallest set of about their size come first. What is in one component then needs no more links in it, so
    of an element's sets only those outside its largest component are paired with the others: a group of copies isn't
    squared, and neither is one that has its boilerplate in common, as that stands last in its order.
    """
    part, whole = share
    n = F.col("n")
    long, short = n - F.ceil(n * part / whole) + 1, n - F.ceil(n * (2 * part) / (whole + part)) + 1
    first = sets.select("root", "text_hash", "n", short.alias("short"), F.posexplode(F.slice("tokens", F.lit(1), long.cast("int"))).alias("at", "token"))
    first = durable(first.withColumn("class", F.floor(F.ln("n") / math.log(1.12)).cast("int")))
    indexed = F.col("at") < F.col("short")
    least = F.min(F.when(indexed, F.struct("n", "text_hash"))).alias("least")
    heads = durable(first.groupBy("root", "token", "class").agg(least, F.count("*").alias("many")).filter("many > 1 AND least IS NOT NULL"))
    pairs = first.join(heads, ["root", "token", "class"]).select(F.col("text_hash").alias("a"), F.col("least.text_hash").alias("b"))
    links = durable(_alike(durable(pairs.filter("a <> b").distinct()), sets, share))
    joined = components(links).select(F.col("node").alias("text_hash"), F.col("root").alias("component"))
    placed = first.join(joined, "text_hash", "left").withColumn("component", F.coalesce("component", "text_hash"))
    placed = durable(placed.select("root", "token", "text_hash", "n", "at", "component", indexed.alias("indexed")))
    held = placed.groupBy("root", "token", "component").agg(F.count("*").alias("many"))
    mains = held.groupBy("root", "token").agg(F.max(F.struct("many", "component")).alias("main"), F.count("*").alias("kinds"))
    mains = durable(mains.filter("kinds > 1").select("root", "token", F.col("main.component").alias("main")))
    open_ = durable(placed.join(mains, ["root", "token"]))
    side = lambda rows, p: rows.select("root", "token", *(F.col(c).alias(f"{p}_{c}") for c in ("text_hash", "n", "at", "component")))
    outside, short_ones = F.col("component") != F.col("main"), F.col("indexed")
    # The smaller of two is indexed by the element, and one of them is outside the largest component.
    one = side(open_.filter(short_ones & outside), "s").join(side(open_, "m"), ["root", "token"])
    other = side(open_.filter(short_ones & ~outside), "s").join(side(open_.filter(outside), "m"), ["root", "token"])
    met = one.unionByName(other).filter("s_component <> m_component AND (s_n < m_n OR (s_n = m_n AND s_text_hash < m_text_hash))")
    met = met.filter(F.col("s_n") * whole >= F.col("m_n") * part)
    # From the first element that they share on, there must be enough left.
    met = met.groupBy(F.col("s_text_hash").alias("b"), F.col("m_text_hash").alias("a"), F.col("s_n").alias("n"), F.col("m_n").alias("m"))
    met = met.agg(F.min("s_at").alias("i"), F.min("m_at").alias("j"))
    left = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j"))
    met = met.filter(left * (whole + part) >= part * (F.col("n") + F.col("m"))).select("a", "b")
    return links.unionByName(_alike(durable(met), sets, share))


def similar_links(docs: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """Stars (a, b) of the text hashes of ``members`` (root, doc_id, text_hash) of one root that are alike by their texts.

    A small group is compared in a task. A large one is dealt to as many tasks as it has parts, its shingles are put in
    order by a sample of its texts, and pairs are compared that ``links_in_large_groups`` finds: no task holds a group.
    """
    named = members.select("root", F.col("doc_id").alias("_id"), "text_hash")
    texts = docs.select("doc_id", "text")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (text_hash(F.col("text")) == F.col("text_hash"))
    joined = texts.join(named, same).select("root", "text_hash", "text")
    joined = durable(joined.dropDuplicates(["root", "text_hash"]) if _repeated(texts) else joined)
    bounded_batches(docs.sparkSession)
    size = F.greatest(F.count("*") / GROUP_ROWS, F.sum(F.coalesce(F.octet_length("text"), F.lit(0))) / GROUP_BYTES)
    parts = F.ceil(size * 2).cast("bigint").alias("parts")
    large = durable(joined.groupBy("root").agg(size.alias("size"), parts).filter("size > 1").select("root", "parts"))
    zero = F.lit(0).cast("bigint")
    small = joined.join(large, "root", "left_anti").select("root", zero.alias("sub"), "text_hash", "text")
    compared = lambda dealt: dealt.repartition("root", "sub").sortWithinPartitions("root", "sub").mapInArrow(_links_of_groups(width), "a bigint, b bigint")
    if large.isEmpty():
        return compared(small)
    big = durable(joined.join(large, "root"))
    place = F.row_number().over(Window.partitionBy("root").orderBy("text_hash"))
    sample = big.withColumn("place", place).filter(F.col("place") <= SAMPLE).withColumn("sub", F.explode(F.sequence(zero, F.col("parts") - 1)))
    dealt = big.withColumn("sub", _part(F.col("text_hash"), F.col("parts")))
    stream = sample.select("root", "sub", F.lit(False).alias("member"), "text_hash", "text").unionByName(
        dealt.select("root", "sub", F.lit(True).alias("member"), "text_hash", "text")
    )
    stream = stream.repartition("root", "sub").sortWithinPartitions("root", "sub", "member")
    sets = durable(stream.mapInArrow(_ordered_sets(width), "root bigint, text_hash bigint, n int, tokens array<bigint>"))
    return compared(small).unionByName(links_in_large_groups(sets))


def _repeated(rows: DataFrame) -> bool:
    """Whether some doc_id stands in more than one row."""
    return not rows.groupBy("doc_id").count().filter("count > 1").isEmpty()


def shingle_links(texts: DataFrame, width: int, share: tuple[int, int] = SIMILAR) -> DataFrame:
    """Stars (a, b) of the hashes of ``texts`` (text_hash, text) that link all whose shingle sets have a similarity of ``share``.

    Others may be linked, too: it is a search, but an exact one. Shingles are ordered by the number of texts that hold
    them, rarest first; two texts as alike as that share one of the first size - ceil(size * share) + 1 of each (the
    prefix). Most of these are held by one text only and link nothing.
    """
    part, whole = share
    schema = pa.schema([("text_hash", pa.int64()), ("token", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            for own, text in zip(batch.column(0).to_pylist(), octets(batch.column(1)), strict=True):
                # A text without words has one token of its own, as two empty sets are alike.
                tokens = np.unique(shingle_hashes(text, width)) if text and text.split() else np.zeros(1, dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(tokens), own)), pa.array(tokens.view(np.int64))], schema=schema)

    bounded_batches(texts.sparkSession)
    held = durable(texts.select("text_hash", "text").mapInArrow(run, "text_hash bigint, token bigint"))
    counts = durable(held.groupBy("token").agg(F.count("*").alias("n")))
    ordered = F.array_sort(F.collect_list(F.struct("n", "token")))
    sets = held.join(counts, "token").groupBy("text_hash").agg(ordered.alias("tokens"))
    first = F.slice("tokens", F.lit(1), (F.size("tokens") - F.ceil(F.size("tokens") * part / whole) + 1).cast("int"))
    prefix = sets.select("text_hash", F.explode(first).alias("t")).filter("t.n > 1")
    prefix = durable(prefix.select("text_hash", F.col("t.token").alias("token")))
    least = durable(prefix.groupBy("token").agg(F.min("text_hash").alias("b")))
    return prefix.join(least, "token").select(F.col("text_hash").alias("a"), "b").filter("a <> b")


def drop_near_copies(
    docs: DataFrame, width: int = 5, lanes: int = 4, radius: int = 64, bits: int | None = None, exact: bool = False
) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, that of the smallest doc_id; its columns, and no others, are kept.

    Texts are linked if their shingle sets have a similarity of SIMILAR or more. Fingerprints only find what is compared:
    two texts with a similarity of 0.8 differ in 39 of 256 bits on average, with a deviation of 5.7, so the radius is
    four deviations above. Shards share ``bits`` sampled bits, by default ``bits_for`` their number, so that a shard stays
    small in a corpus of any size; the tables grow with the bits, and what is missed stays the same. All texts of a group of
    fingerprints are compared by their sets, and what is alike makes the components. Repeated rows are copies of each other:
    one stays.

    With ``exact``, ``shingle_links`` finds what is compared in place of the fingerprints: no link is missed, at the price
    of two shuffles of all shingles. Beyond about two billion texts that is also less than all the tables.
    """
    prints = durable(fingerprints(docs, width, lanes))
    fps = [f"fp{i}" for i in range(lanes)]
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *fps)).alias("first")
    texts = prints.groupBy("text_hash").agg(first).select("text_hash", "first.doc_id", *(f"first.{f}" for f in fps))
    if exact:
        texts = durable(texts.withColumn("id", F.col("text_hash")))
        stars = shingle_links(docs.select(text_hash(F.col("text")).alias("text_hash"), "text").dropDuplicates(["text_hash"]), width)
    else:
        # An id of 64 bits for a longer fingerprint; where two share it, their texts are compared in one group.
        texts = durable(texts.withColumn("id", F.xxhash64(*fps)))
        points = durable(texts.select("id", *fps).distinct())
        masks = sampled_bits(lanes, bits_for(points.count()) if bits is None else bits)
        stars = near_links(points, lanes, radius, masks, None)
    roots = components(stars).withColumnRenamed("node", "id")
    rooted = durable(texts.join(roots, "id", "left").select("text_hash", "doc_id", F.coalesce("root", "id").alias("root")))
    several = durable(rooted.groupBy("root").count().filter("count > 1").select("root"))
    members = durable(rooted.join(several, "root", "left_semi"))
    alike = components(similar_links(docs, members, width)).select(F.col("node").alias("text_hash"), F.col("root").alias("like"))
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("least")
    kept = rooted.join(alike, "text_hash", "left").groupBy(F.coalesce("like", "text_hash")).agg(least)
    own_hash, kept_id, kept_hash = free_names(docs.columns, "_text_hash", "_kept_id", "_kept_hash")
    kept = durable(kept.select(F.col("least.doc_id").alias(kept_id), F.col("least.text_hash").alias(kept_hash)))
    same_id = F.col("doc_id").eqNullSafe(F.col(kept_id))
    if not _repeated(prints):
        return docs.join(kept, same_id, "left_semi").select(*own_columns(docs))
    marked = docs.withColumn(own_hash, text_hash(F.col("text")))
    same = same_id & (F.col(own_hash) == F.col(kept_hash))
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", own_hash]).select(*own_columns(docs))


def op10_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
