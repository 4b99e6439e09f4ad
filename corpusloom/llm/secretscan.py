r"""Secret scans through an incremental blob ledger, in DataFrame functions alone.

Every historical version of a file is addressed by the SHA-256 of its content. The ledger holds, for each blob that was
ever scanned, the rule versions it was scanned with and what they found. A scan takes the distinct blobs of the history
given, leaves out the pairs of blob and rule version that the ledger has, scans the rest, appends one batch to the
ledger and joins the findings back to all paths. A rule that changes gets a new version, so only that rule runs again;
blobs that were seen are never read by a regular expression again.

Copies meet in a map-side aggregate before the shuffle, so a blob of very many paths costs one row a task. Findings
are joined to (path, blob) rows, without texts; Spark splits a blob of very many paths there.

Positions are code points: running sums of the lengths of what stands between the matches and of the matches.

Defined cases: a null text is the empty blob; a null path is a path; repeated rows each get their findings; an empty
history appends nothing and gives no rows; matches that fail a rule's least length are dropped after they have matched,
so they still hide what they overlap; other columns are kept as they are, but blob and findings take the place of
columns of these names.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from corpusloom.llm.common import durable, free_names, quoted, shared_folder, table


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """kind; version, to be raised with any change; pattern; group whose length counts, and the least such length;
    needs: strings of which every match contains one."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    needs: tuple[str, ...]
    base: bool = False

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


_KEYS = "|".join([*map(_either_case, ("password", "passwd", "secret", "token")), f"{_either_case('api')}_?{_either_case('key')}"])
#: Spans that start at the same place stand in this order.
RULES = (
    Rule("assign", 1, rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, (":", "="), True),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20, ("AKIA",), True),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24, (), True),
    Rule("github", 1, r"gh[opsu]_[A-Za-z0-9]{36,}", 0, 40, ("gho_", "ghp_", "ghs_", "ghu_")),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 36, ("eyJ",)),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 27, ("PRIVATE KEY-----",)),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, ("xox",)),
)
_PIECES = "array<struct<rule: string, i: int, gap: int, size: int, kept: boolean>>"
_FINDINGS = "array<struct<rule: string, start: bigint, end: bigint>>"


def rule_pieces(text: Column, rule: Rule) -> Column:
    """A rule's matches in ``text``, in order: the code points before each since the last, its own, and whether it is long enough."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    between = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(found))
    pairs = F.zip_with(between, found, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))

    def piece(pair: Column, i: Column) -> Column:
        size = F.length(pair["hit"])
        kept = (F.length(F.regexp_extract(pair["hit"], rule.pattern, rule.group)) if rule.group else size) >= rule.least
        return F.struct(F.lit(rule.name).alias("rule"), i.alias("i"), F.length(pair["gap"]).alias("gap"), size.alias("size"), kept.alias("kept"))

    pieces = F.transform(pairs, piece)
    if rule.needs:
        some = text.contains(rule.needs[0])
        for need in rule.needs[1:]:
            some = some | text.contains(need)
        pieces = F.when(some, pieces).otherwise(F.array().cast(_PIECES))
    return pieces


def scanned(todo: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, seen, findings) of ``todo`` (id, content, todo: names of the rules to run).

    Positions are running sums over a blob's matches, one row a match: a text of very many takes time in proportion. The
    rows stay where the blob is, as they are dealt by its id already.
    """
    none = F.array().cast(_PIECES)
    each = [F.when(F.array_contains("todo", r.name), rule_pieces(F.col("content"), r)).otherwise(none) for r in rules]
    rows = todo.select("id", "todo", F.inline_outer(F.concat(*each)))
    upto = Window.partitionBy("id", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto))
    finding = F.struct("rule", (F.col("end") - F.col("size")).cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"))
    found = F.array_sort(F.collect_list(F.when(F.col("kept"), finding)))
    return rows.groupBy(F.col("id").alias("blob")).agg(F.first("todo").alias("seen"), found.cast(_FINDINGS).alias("findings"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """(blob, seen: names of rule versions, findings: what they found)."""
    schema = "blob string, seen array<string>, findings array<struct<rule: string, start: bigint, end: bigint>>"
    try:
        return spark.read.schema(schema).parquet(f"{ledger}/batch=*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan(history: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The columns of ``history`` with blob and findings (rule name, start, end) of the current rules.

    ``history`` has a row for each version of each path; unseen pairs of blob and rule version are scanned and appended to
    the folder ``ledger``. A batch that is written twice, after a failure, is harmless. Of the ledger only the blobs of
    ``history`` are put together; Spark's filter on their ids reaches its scan where they are few.
    """
    spark = history.sparkSession
    names = F.array(*(F.lit(r.name) for r in rules))
    content = F.coalesce(F.col(quoted(text)), F.lit(""))
    (own,) = free_names([*history.columns, "blob", "findings"], "_blob")
    addressed = history.withColumn(own, F.sha2(content, 256))
    ids = addressed.select(F.col(own).alias("id")).distinct()
    known = read_ledger(spark, ledger)
    first_scan = known.isEmpty()
    blobs = addressed.groupBy(F.col(own).alias("id")).agg(F.first(content).alias("content"))
    if first_scan:
        todo = blobs.withColumn("todo", names)
    else:
        here = known.select("blob", "seen").join(ids, F.col("blob") == F.col("id"), "left_semi")
        seen = here.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("seen"))).alias("seen"))
        unseen = F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))
        todo = blobs.join(seen, F.col("id") == F.col("blob"), "left").withColumn("todo", unseen).filter(F.size("todo") > 0)
    scanned(todo, rules).write.parquet(f"{ledger}/batch={uuid.uuid4().hex}")
    current = read_ledger(spark, ledger)
    if not first_scan:  # of a ledger that has grown long, only the blobs at hand are put together
        current = current.join(ids, F.col("blob") == F.col("id"), "left_semi")
    current = current.withColumn("findings", F.filter("findings", lambda x: F.array_contains(names, x["rule"])))
    # A pair that two batches hold, after a repeated run, counts once.
    current = current.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("findings"))).alias("sorted"))
    again = lambda x, i: (i > 0) & (x == F.get("sorted", i - 1))
    current = current.select("blob", F.filter("sorted", lambda x, i: ~again(x, i)).alias("findings"))
    # Written, so that both sides of the join are plain shuffles, of which Spark splits a blob of very many paths.
    current = durable(current)
    kept = [F.col(quoted(c)) for c in history.columns if c.lower() not in ("blob", "findings")]
    paths = addressed.select(*kept, F.col(own))
    return paths.join(current, paths[own] == current["blob"], "left").drop(own)


def _digest(rules: tuple[Rule, ...]) -> Column:
    """kind:start:end of the findings of ``rules``, by start, then kind as listed."""
    place = F.map_from_arrays(F.array(*(F.lit(r.name) for r in rules)), F.array(*(F.lit(i) for i in range(len(rules)))))
    kept = F.filter("findings", lambda x: F.array_contains(F.map_keys(place), x["rule"]))
    keyed = F.transform(kept, lambda x: F.struct(x["start"].alias("start"), F.element_at(place, x["rule"]).alias("k"), x["end"].alias("end"), F.substring_index(x["rule"], "@", 1).alias("kind")))
    return F.array_join(
        F.transform(F.array_sort(keyed), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def _count(kind: str) -> Column:
    return F.size(F.filter("findings", lambda x: F.substring_index(x["rule"], "@", 1) == kind)).cast("bigint")


def op3_secrets_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}")
    return found.select(
        "doc_id",
        _count("assign").alias("n_assign"),
        _count("access").alias("n_access"),
        _count("hex").alias("n_hex"),
        F.sha2(_digest(tuple(r for r in RULES if r.base)), 256).alias("base_sha256"),
        _digest(RULES).alias("spans"),
    )


def _sql_spans(rule: Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    size = f"len(regexp_extract(hit[i], '{pattern}', {rule.group}))" if rule.group else "len(hit[i])"
    return f"""list_filter(list_transform(range(1, len(hit) + 1), lambda i: {{
        'start': list_sum(list_transform(gap[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(hit[1:i - 1], lambda x: len(x))), 0),
        'k': {RULES.index(rule)}, 'n': len(hit[i]), 'kind': '{rule.kind}', 'kept': {size} >= {rule.least}}}), lambda x: x.kept)"""


def _sql_text(spans: str) -> str:
    return f"array_to_string(list_transform(list_sort({spans}), lambda x: concat(x.kind, ':', x.start, ':', x.start + x.n)), ',')"


def _sql_parts() -> str:
    parts = []
    for r in RULES:
        pattern = r.pattern.replace("'", "''")
        both = f"SELECT r, string_split_regex(text, '{pattern}') AS gap, regexp_extract_all(text, '{pattern}') AS hit FROM docs"
        parts.append(f"{r.kind}_ AS (SELECT r, {_sql_spans(r)} AS s FROM ({both}))")
    return ", ".join(parts)


_BASE = "list_concat(list_concat(assign_.s, access_.s), hex_.s)"
_MORE = "list_concat(list_concat(github_.s, jwt_.s), list_concat(pem_.s, slack_.s))"
OP3_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents), {_sql_parts()}
SELECT doc_id, len(assign_.s)::BIGINT AS n_assign, len(access_.s)::BIGINT AS n_access, len(hex_.s)::BIGINT AS n_hex,
       sha256({_sql_text(_BASE)}) AS base_sha256,
       {_sql_text(f"list_concat({_BASE}, {_MORE})")} AS spans
FROM docs {" ".join(f"JOIN {r.kind}_ USING (r)" for r in RULES)}
"""
