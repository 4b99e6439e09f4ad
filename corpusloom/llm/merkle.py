"""A Merkle manifest of a dataset: a digest for each document and source, the root, and a proof for each document.

A node is the SHA-256, in hex, of its up to RUN children's hex digests; a document's leaf is that of its fields. Leaves stand
in order of doc_id within their source, and the sources' roots in order of their names under the root of all.

Leaves are placed within their source by ranges, so a source of a third of all documents lies in as many tasks as its share. Every
RUN ** LEVELS consecutive ones meet as one ordered array, a block, whatever the size of their source, and sequence, transform and
slice collapse its levels inside the expression, natively. The roots of the blocks are the leaves of the next round, until a source
is one block; then the sources' roots go the same way. On the way back each block is given the siblings above it, and hands
each of its nodes their own: texts have been left behind with the first step, and a row never holds more than a block.

Defined cases: a null field is ``-``; a null doc_id comes first in its source, documents of one doc_id in order of their leaves, so
repeated rows are leaves of their own; a null source is a source of its own, the first; an empty text has 0 bytes; an empty table has no
root and no rows; other columns are no part of a leaf. A single leaf is its source's root, and a single source's root the root of all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import ascii_lower, durable, table
from corpusloom.llm.mixing import places

#: Children of a node, and levels that a block collapses at once: a block is RUN ** LEVELS nodes.
RUN, LEVELS = 16, 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: list[Column]) -> Column:
    """The digest of ``fields``: each its bytes in UTF-8, a colon and the value, or ``-`` if null."""

    def told(value: Column) -> Column:
        text = value.cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return digest(*map(told, fields))


def _slice(values: Column, start: Column, many: Column | int) -> Column:
    """``many`` elements from ``start``, counted from 0, or as many as there are, as one string."""
    return F.array_join(F.slice(values, (start + 1).cast("int"), many.cast("int") if isinstance(many, Column) else F.lit(many)), "")


def _runs(n: Column) -> Column:
    """0, 1 .. for each run of ``n`` nodes."""
    return F.sequence(F.lit(0), F.floor((n - 1) / RUN).cast("int"))


def _collapsed(level: Column) -> Column:
    """The digests of the runs of ``level``, in order."""
    return F.transform(_runs(F.size(level)), lambda r: F.sha2(_slice(level, r * RUN, RUN), 256))


def blocks_of(nodes: DataFrame, tree: str, at: str, node: str, payload: list[str]) -> DataFrame:
    """(tree, block, several, nodes, level0, level1 .., top) of ``nodes`` in blocks; several tells whether their tree has other blocks.

    ``at`` is a node's place in its tree, from 0. Levels beyond the top are left as they are: they are no part of the tree.
    """
    size = RUN**LEVELS
    held = F.struct(F.col(at).alias("at"), F.col(node).alias("node"), *payload)
    grouped = nodes.groupBy(F.col(tree).alias("tree"), F.floor(F.col(at) / size).cast("bigint").alias("block"))
    out = durable(grouped.agg(F.array_sort(F.collect_list(held)).alias("nodes")))
    trees = durable(out.groupBy("tree").agg((F.max("block") > 0).alias("several")))
    out = out.join(trees, "tree").withColumn("level0", F.transform("nodes", lambda x: x["node"]))
    for k in range(LEVELS):
        out = out.withColumn(f"level{k + 1}", _collapsed(F.col(f"level{k}")))
    top = F.col(f"level{LEVELS}")[0]
    for k in reversed(range(LEVELS)):
        top = F.when(~F.col("several") & (F.size(f"level{k}") == 1), F.col(f"level{k}")[0]).otherwise(top)
    return durable(out.withColumn("top", top))


def _siblings(level: Column, at: Column) -> Column:
    """What stands left and right of place ``at`` in its run."""
    first = at - at % RUN
    return F.struct(_slice(level, first, at % RUN).alias("left"), _slice(level, at + 1, F.lit(RUN - 1) - at % RUN).alias("right"))


def _within(first_level: int, at: Column) -> Column:
    """The siblings on the levels from ``first_level`` on that are in the tree, of node ``at`` of that level."""
    parts = []
    for k in range(first_level, LEVELS):
        level = F.col(f"level{k}")
        place = F.floor(at / RUN ** (k - first_level)).cast("int")
        parts.append(F.when(F.col("several") | (F.size(level) > 1), F.array(_siblings(level, place))).otherwise(F.array().cast(_PATH)))
    return F.concat(*parts) if parts else F.array().cast(_PATH)


def nodes_with_paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Each node of ``blocks`` with its path to the root of all, from the paths ``above`` (tree, at: block, path, any more) of the blocks."""
    joined = blocks.join(above.withColumnRenamed("at", "block"), ["tree", "block"])
    more = [c for c in above.columns if c not in ("tree", "at", "path")]
    # A run at a time, so that a row holds RUN nodes and not the block; what is above is the same for the run.
    run = F.transform(
        _runs(F.size("nodes")),
        lambda r: F.struct(F.slice("nodes", r * RUN + 1, F.lit(RUN)).alias("run"), F.concat(_within(1, r), F.col("path")).alias("above")),
    )
    first = F.when(F.col("several") | (F.size("nodes") > 1), F.lit(True)).otherwise(F.lit(False)).alias("first")
    runs = joined.select("tree", *more, first, F.inline(run))
    own = F.transform(F.col("run"), lambda x: x["node"])
    each = runs.select("tree", *more, "first", "above", own.alias("level"), F.posexplode("run").alias("i", "x"))
    path = F.when(F.col("first"), F.concat(F.array(_siblings(F.col("level"), F.col("i"))), F.col("above"))).otherwise(F.col("above"))
    return each.select("tree", *more, "x.*", path.alias("path"))


def climb(nodes: DataFrame, payload: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of all rounds, first to last, and (tree, node) of the roots of ``nodes`` (tree, at, node, payload)."""
    rounds = []
    while True:
        blocks = blocks_of(nodes, "tree", "at", "node", payload)
        rounds.append(blocks)
        tops = blocks.select("tree", F.col("block").alias("at"), F.col("top").alias("node"))
        if blocks.filter("several").isEmpty():
            return rounds, tops.select("tree", "node")
        nodes, payload = tops, []


def descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The nodes of the first round with their paths, given those of the trees' roots ``above`` (tree, path, any more)."""
    above = above.withColumn("at", F.lit(0).cast("bigint"))
    for k in reversed(range(len(rounds))):
        above = nodes_with_paths(rounds[k], above)
        if k:
            above = durable(above.drop("node"))
    return above


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof(path: Column) -> Column:
    """The digest of all siblings, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def tampered(doc_id: Column) -> Column:
    """Whether the document is one whose text is tampered with."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def manifest(docs: DataFrame, changed: Column | None = None) -> tuple[DataFrame, str | None]:
    """(source, doc_id, leaf, changed_leaf, path, subroot) of each row of ``docs``, and the root.

    With ``changed``, a text in place of the row's own, changed_leaf is the leaf of that; else it is the leaf. A path has the
    siblings from the leaf to the root.
    """
    fields = [F.col(c) for c in FIELDS]
    other = leaf_digest([*fields[:-1], changed]) if changed is not None else F.lit(None).cast("string")
    leaf = leaf_digest(fields)
    tree = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source")))  # '' comes first
    leaves = docs.select(tree.alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"), leaf.alias("node"), other.alias("changed"))
    # Only digests go on; a changed leaf only where it differs.
    leaves = durable(leaves.withColumn("changed", F.when(F.col("changed") != F.col("node"), F.col("changed"))))
    placed = places(leaves, ["tree"], [F.col("doc_id").asc_nulls_first(), F.col("node")], "at").withColumn("at", F.col("at") - 1)
    rounds, subroots = climb(placed, ["doc_id", "changed"])
    subroots = durable(subroots.select(F.lit("").alias("all"), F.col("tree").alias("source"), "node"))
    ordered = places(subroots, ["all"], [F.col("source")], "at").select(F.col("all").alias("tree"), (F.col("at") - 1).alias("at"), "node", "source")
    source_rounds, roots = climb(ordered, ["source"])
    found = roots.first()
    root = found["node"] if found else None
    top = roots.select("tree", F.array().cast(_PATH).alias("path"))
    above = durable(descend(source_rounds, top).select(F.col("source").alias("tree"), "path", F.col("node").alias("subroot")))
    rows = descend(rounds, above)
    source = F.when(F.col("tree") != "", F.substring("tree", 2, 2**31 - 1))
    return rows.select(
        source.alias("source"), "doc_id", F.col("node").alias("leaf"), F.coalesce("changed", "node").alias("changed_leaf"), "path", "subroot"
    ), root


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    changed = F.when(tampered(F.col("doc_id")), ascii_lower(F.col("text"))).otherwise(F.col("text"))
    rows, root = manifest(docs, changed)
    return rows.select(
        "doc_id", "leaf", "subroot", F.lit(root).cast("string").alias("root"), proof(F.col("path")).alias("proof_sha256"),
        folded(F.col("changed_leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_leaf(text: str) -> str:
    told = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END"
    return f"sha256(concat({', '.join(told(c) for c in (*FIELDS[:-1], text))}))"


#: The CRC-32 of a decimal number, bit by bit: each byte is taken in with its first step, and seven steps follow.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
  lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, b: CASE WHEN xor(a, greatest(b, 0)) % 2 = 1 THEN xor(xor(a, greatest(b, 0)) // 2, 3988292384::BIGINT) ELSE xor(a, greatest(b, 0)) // 2 END), 4294967295::BIGINT)"""
_UP = f"list_transform(range((len(d) + {RUN - 1}) // {RUN}), lambda i: sha256(array_to_string(d[i * {RUN} + 1:i * {RUN} + {RUN}], '')))"
_SIDES = f"""list_transform(range(len(d)), lambda i: {{'l': array_to_string(d[i - i % {RUN} + 1:i], ''), 'r': array_to_string(d[i + 2:i - i % {RUN} + {RUN}], '')}})"""
OP13_SQL = f"""
WITH RECURSIVE docs AS (SELECT *, {_sql_leaf('text')} AS leaf,
    {_sql_leaf('changed')} AS changed_leaf
  FROM (SELECT *, CASE WHEN doc_id IS NOT NULL AND {_CRC} % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed FROM documents)),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot FROM docs),
up AS (SELECT source, 0 AS k, list(leaf ORDER BY spot) AS d FROM placed GROUP BY source
  UNION ALL SELECT source, k + 1, {_UP} FROM up WHERE len(d) > 1),
tops AS (SELECT source, any_value(d[1]) AS subroot FROM up WHERE len(d) = 1 GROUP BY source),
sources AS (SELECT *, row_number() OVER (ORDER BY source IS NOT NULL, source::BLOB) - 1 AS place FROM tops),
over_all AS (SELECT 0 AS k, list(subroot ORDER BY place) AS d FROM sources
  UNION ALL SELECT k + 1, {_UP} FROM over_all WHERE len(d) > 1),
sides AS (SELECT source, k, {_SIDES} AS s FROM up WHERE len(d) > 1),
top_sides AS (SELECT k, {_SIDES} AS s FROM over_all WHERE len(d) > 1),
lower_path AS (SELECT p.source, spot, list(s[spot // ({RUN}**k)::BIGINT + 1] ORDER BY k) AS path FROM (SELECT DISTINCT source, spot FROM placed) p JOIN sides x ON p.source IS NOT DISTINCT FROM x.source GROUP BY p.source, spot),
upper_path AS (SELECT source, list(s[place // ({RUN}**k)::BIGINT + 1] ORDER BY k) AS path FROM sources, top_sides GROUP BY source),
joined AS (SELECT p.*, t.subroot, (SELECT d[1] FROM over_all WHERE len(d) = 1) AS root,
    list_concat(coalesce(l.path, []), coalesce(u.path, [])) AS path
  FROM placed p JOIN tops t ON p.source IS NOT DISTINCT FROM t.source
  LEFT JOIN lower_path l ON p.source IS NOT DISTINCT FROM l.source AND p.spot = l.spot
  LEFT JOIN upper_path u ON p.source IS NOT DISTINCT FROM u.source),
folds AS (SELECT *, list_reduce(list_prepend(changed_leaf, list_transform(path, lambda x: x.l || '|' || x.r)),
    lambda a, b: sha256(concat(split_part(b, '|', 1), a, split_part(b, '|', 2)))) AS folded_root FROM joined)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: x.l || x.r), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified FROM folds
"""
