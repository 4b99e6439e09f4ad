"""The named queries over the bundled tables, each with DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import jsontext, text, variants
from corpusloom.operators import records
from corpusloom.streaming import events as streaming

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
KEYWORDS = ["Under", "the", "password", "license", "and"]


def query(sql: str | None) -> Callable:
    def register(f: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


@query("""
SELECT conv_id, count(*) AS n_turns, arg_max(role, turn) AS last_role, CASE WHEN len(t) > 40 THEN substr(t, 1, 40) || '... [truncated ' || (len(t) - 40) || ' chars]' ELSE t END AS last_text
FROM (SELECT *, arg_max(coalesce(text, ''), turn) OVER (PARTITION BY conv_id) AS t FROM conversations) GROUP BY conv_id, t""")
def conversation_summary(t, spark, sf_dir):
    last = F.max_by(F.struct("role", "text"), "turn").alias("last")
    rows = t("conversations").groupBy("conv_id").agg(F.count("*").alias("n_turns"), last)
    return rows.select("conv_id", "n_turns", F.col("last.role").alias("last_role"), text.clip(F.coalesce("last.text", F.lit("")), 40).alias("last_text"))


@query(r"""SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[\r\n]', ' ', 'g'), ' {2,}', ' ', 'g')) AS text FROM documents""")
def text_normalize(t, spark, sf_dir):
    return t("documents").select("doc_id", text.normalize(F.col("text")).alias("text"))


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents")
def text_sha256(t, spark, sf_dir):
    return t("documents").select("doc_id", text.sha256(F.col("text")).alias("sha256"))


@query("""SELECT doc_id, CASE WHEN len(text) > 80 THEN substr(text, 1, 80) || '... [truncated ' || (len(text) - 80) || ' chars]' ELSE text END AS clipped FROM documents""")
def text_clip(t, spark, sf_dir):
    return t("documents").select("doc_id", text.clip(F.col("text"), 80).alias("clipped"))


@query("""SELECT doc_id, array_to_string(list_filter(['under', 'the', 'password', 'license', 'and'], lambda k: contains(lower(text), k))[1:3], ',') AS tags FROM documents""")
def keyword_tag(t, spark, sf_dir):
    return t("documents").select("doc_id", F.array_join(text.keyword_tags(F.col("text"), KEYWORDS, 3), ",").alias("tags"))


@query("""SELECT page_id, regexp_replace(url, '[^\\p{L}\\p{N}_-]', '_', 'g') AS name FROM pages""")
def safe_file_name(t, spark, sf_dir):
    return t("pages").select("page_id", text.safe_name(F.col("url")).alias("name"))


@query("""SELECT doc_id, nullif(try_cast(regexp_extract(source, '^src0*([0-9]+)$', 1) AS BIGINT), 0) AS source_number FROM documents""")
def index_from_id(t, spark, sf_dir):
    return t("documents").select("doc_id", text.index_from_id(F.col("source"), "src").alias("source_number"))


@query("""SELECT p_partkey, list_filter(list_transform(string_split(replace(p_name, ' ', ' , '), ','), lambda x: trim(x)), lambda x: x <> '') AS words FROM part""")
def split_args(t, spark, sf_dir):
    return t("part").select("p_partkey", text.split_args(F.regexp_replace("p_name", " ", " , ")).alias("words"))


@query("""SELECT doc_id, coalesce(nullif(lang, 'en'), nullif(source, ''), 'none') AS label FROM documents""")
def alias_fallback(t, spark, sf_dir):
    return t("documents").select("doc_id", F.coalesce(text.first_full(F.nullif("lang", F.lit("en")), F.col("source")), F.lit("none")).alias("label"))


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS sha256 FROM documents GROUP BY text")
def exact_dedup_first(t, spark, sf_dir):
    docs = t("documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    return records.first_of_each(docs, F.col("sha256"), "doc_id")


@query("""WITH lines AS (SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS old,
  trim(regexp_replace(regexp_replace(text, '[\\r\\n]', ' ', 'g'), ' {2,}', ' ', 'g')) AS t FROM documents)
SELECT min(doc_id) AS doc_id FROM lines WHERE NOT old AND t IS NOT NULL AND t NOT IN (SELECT t FROM lines WHERE old AND t IS NOT NULL) GROUP BY t""")
def dedup_against_known(t, spark, sf_dir):
    docs = t("documents").select("doc_id", text.sha256(text.normalize(F.col("text"))).alias("sha256")).filter("sha256 IS NOT NULL")
    labelled = t("labels").select("doc_id").distinct()
    fresh, known = docs.join(labelled, "doc_id", "left_anti"), docs.join(labelled, "doc_id", "left_semi")
    return records.first_of_each(records.new_only(fresh, known, "sha256"), F.col("sha256"), "doc_id").select("doc_id")


@query("""SELECT doc_id, group_first, group_size FROM (SELECT doc_id, min(doc_id) OVER w AS group_first, count(*) OVER w AS group_size FROM documents WINDOW w AS (PARTITION BY text)) WHERE group_size > 1""")
def duplicate_groups(t, spark, sf_dir):
    docs = t("documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    return records.with_group(docs, F.col("sha256"), "doc_id").select("doc_id", "group_first", "group_size")


@query("""SELECT conv_id, turn, list(text) OVER (PARTITION BY conv_id, role ORDER BY turn ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS recent FROM conversations""")
def recent_k_same_role(t, spark, sf_dir):
    recent = records.recent_same(t("conversations"), ["conv_id", "role"], "turn", "text", 5)
    return recent.select("conv_id", "turn", F.when(F.size("recent") > 0, F.col("recent")).alias("recent"))


@query("""SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS latest FROM events""")
def latest_nonnull_state(t, spark, sf_dir):
    value = F.when(F.col("event_type") == "purchase", F.col("value"))
    return records.latest_known(t("events"), ["user_id"], ["ts", "event_id"], value).select("event_id", "user_id", "latest")


@query("""SELECT conv_id, role, min(turn) AS run_start, count(*) AS run_length FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS island FROM conversations)
GROUP BY conv_id, role, island""")
def role_runs(t, spark, sf_dir):
    return records.runs(t("conversations"), ["conv_id"], "turn", "role")


@query("""SELECT event_id, user_id, event_type FROM (
  SELECT *, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS following FROM events) WHERE following IS NULL OR following <> event_type""")
def collapse_repeats(t, spark, sf_dir):
    return records.collapse_repeats(t("events"), ["user_id"], ["ts", "event_id"], ["event_type"]).select("event_id", "user_id", "event_type")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_keys(t, spark, sf_dir):
    return records.new_only(t("documents").select("doc_id"), t("labels"), "doc_id")


@query("""SELECT k AS doc_id, k IN (SELECT doc_id FROM labels) AS found FROM (SELECT DISTINCT doc_id * 3 AS k FROM labels)""")
def lookup_with_missing(t, spark, sf_dir):
    asked = t("labels").select((F.col("doc_id") * 3).alias("doc_id")).distinct()
    have = t("labels").select("doc_id").distinct().withColumn("found", F.lit(True))
    return asked.join(have, "doc_id", "left").select("doc_id", F.coalesce("found", F.lit(False)).alias("found"))


@query("""WITH fresh AS (SELECT doc_id + 100 AS doc_id, 9 AS quality, doc_id AS pos FROM labels)
SELECT doc_id, quality FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM fresh) UNION ALL SELECT doc_id, quality FROM fresh""")
def upsert_by_key(t, spark, sf_dir):
    old = t("labels").select("doc_id", "quality", F.col("doc_id").alias("pos"))
    new = old.select((F.col("doc_id") + 100).alias("doc_id"), F.lit(9).cast("int").alias("quality"), "pos")
    return records.upsert(old, new, "doc_id", "pos").select("doc_id", "quality")


@query("""SELECT doc_id, row_number() OVER (ORDER BY n IS NULL, n, doc_id) AS place FROM (
  SELECT doc_id, nullif(try_cast(regexp_extract(source, '^src0*([0-9]+)$', 1) AS BIGINT), 0) AS n FROM documents)""")
def ordered_rewrite(t, spark, sf_dir):
    docs = t("documents").select("doc_id", text.index_from_id(F.col("source"), "src").alias("n"))
    order = [F.col("n").asc_nulls_last(), F.col("doc_id")]
    return records.numbered(docs, order, "place", streaming.working_folder(spark)).select("doc_id", "place")


@query("SELECT doc_id, lang FROM documents ORDER BY doc_id DESC LIMIT 20 OFFSET 40")
def page_desc(t, spark, sf_dir):
    return records.page(t("documents").select("doc_id", "lang"), "doc_id", 40, 20)


@query("""SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n <= 3""")
def last_k_per_key(t, spark, sf_dir):
    return records.last_k(t("events").select("event_id", "user_id", "ts"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 3).select("event_id", "user_id")


@query("""SELECT conv_id, texts[-2:] AS last_texts FROM (SELECT conv_id, list(text ORDER BY turn) AS texts FROM conversations GROUP BY conv_id)""")
def last_elements(t, spark, sf_dir):
    # The last two of each are chosen before anything is gathered.
    last = records.last_k(t("conversations").select("conv_id", "turn", "text"), ["conv_id"], [F.desc("turn")], 2)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"])
    return last.groupBy("conv_id").agg(parts.alias("last_texts"))


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1 AND event_type <> 'purchase'""")
def active_keys(t, spark, sf_dir):
    return records.active(t("events"), "user_id", ["ts", "event_id"], F.col("event_type") == "purchase").select("user_id", "event_id", "event_type")


@query("""SELECT conv_id, role, string_agg(text, '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id, role""")
def joined_text(t, spark, sf_dir):
    return records.joined_text(t("conversations"), ["conv_id", "role"], "turn", "text")


@query("""SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS high, least(100, round(100.0 * count(*) FILTER (value > 50) / count(*)))::INT AS percent FROM events GROUP BY event_type""")
def status_breakdown(t, spark, sf_dir):
    rows = t("events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 50).alias("high"))
    return rows.withColumn("percent", records.percent_done(F.col("high"), F.col("n")))


@query(r"""SELECT event_id, regexp_matches(props, '^\{"k": -?[0-9]+\}$') AS valid, try_cast(regexp_extract(props, '"k": (-?[0-9]+)', 1) AS BIGINT) AS k FROM events""")
def json_props_valid(t, spark, sf_dir):
    schema = {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer"}}, "additionalProperties": False}
    errors = variants.variant_errors(F.col("props"), schema)
    return t("events").select("event_id", (F.size(errors) == 0).alias("valid"), F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("""SELECT conv_id, turn, list_filter([CASE WHEN text IS NULL THEN '$.text: missing' END,
  CASE WHEN role NOT IN ('user', 'assistant') THEN '$.role: not in enum' END, CASE WHEN turn % 3 = 0 THEN '$.parts[1].n: not integer' END], lambda x: x IS NOT NULL) AS errors FROM conversations""")
def nested_shape_errors(t, spark, sf_dir):
    """Turns as nested JSON, every third of them with a number that is a string; the errors have their paths."""
    part = lambda n: F.named_struct(F.lit("n"), n)
    odd = F.when(F.col("turn") % 3 == 0, '{"n": "x"}').otherwise(F.to_json(part(F.col("turn"))))
    parts = F.concat(F.lit('"parts": ['), F.to_json(part(F.col("turn"))), F.lit(", "), odd, F.lit("]"))
    record = F.concat(F.lit("{"), parts, F.lit(", "), F.substr(F.to_json(F.struct("role", "text")), F.lit(2)))
    number = {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer"}}, "additionalProperties": False}
    schema = {
        "type": "object", "required": ["role", "text", "parts"], "additionalProperties": False,
        "properties": {"role": {"type": "string", "enum": ["user", "assistant"]}, "text": {"type": "string"}, "parts": {"type": "array", "items": number}},
    }
    return t("conversations").select("conv_id", "turn", variants.variant_errors(record, schema).alias("errors"))


@query("""SELECT event_id, sha256('{"k": ' || regexp_extract(props, '"k": (-?[0-9]+)', 1) || '}') AS digest, sha256('{"k":' || regexp_extract(props, '"k": (-?[0-9]+)', 1) || '}') AS signature FROM events""")
def json_digests(t, spark, sf_dir):
    return t("events").select("event_id", jsontext.json_digest(F.col("props")).alias("digest"), jsontext.json_digest(F.col("props"), True).alias("signature"))


@query("""SELECT conv_id, bool_and(role IN ('user', 'assistant', 'system') AND len(trim(text)) > 0) AS valid, count(*) FILTER (NOT (role IN ('user', 'assistant', 'system') AND len(trim(text)) > 0)) AS n_bad FROM conversations GROUP BY conv_id""")
def turn_shape_check(t, spark, sf_dir):
    good = F.coalesce(F.col("role").isin("user", "assistant", "system") & (F.length(F.trim("text")) > 0), F.lit(False))
    return t("conversations").groupBy("conv_id").agg(F.bool_and(good).alias("valid"), F.count_if(~good).alias("n_bad"))


@query("""SELECT doc_id, n_chars = len(text) AS sized, lang IN ('de', 'en', 'es', 'fr') AS known FROM documents""")
def integrity(t, spark, sf_dir):
    return t("documents").select("doc_id", (F.col("n_chars") == F.length("text")).alias("sized"), F.col("lang").isin("de", "en", "es", "fr").alias("known"))


@query("""SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id HAVING count(*) < 4""")
def short_records(t, spark, sf_dir):
    rows = t("conversations").groupBy("conv_id").agg(F.count("*").alias("n"))
    return rows.filter("n < 4")


@query("""SELECT d.lang, count(*) AS n, sum(quality)::BIGINT AS good FROM documents d JOIN labels l USING (doc_id) WHERE toxic = 0 GROUP BY d.lang""")
def exclusion_filter(t, spark, sf_dir):
    rows = t("documents").select("doc_id", "lang").join(t("labels").filter("toxic = 0"), "doc_id")
    return rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum("quality").alias("good"))


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def event_windows_stream(t, spark, sf_dir):
    static = t("events")
    folder = streaming.working_folder(spark)
    source = streaming.growing(spark, sf_dir, static.schema, "events.parquet", files=1_000_000)  # one batch, so nothing is late
    out = streaming.updated(streaming.windowed(source, late="2 days"), F.struct("w", "event_type"), folder)
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("""SELECT n_name, count(*) AS n_orders, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def star_join(t, spark, sf_dir):
    lines = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    lines = lines.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return lines.groupBy("n_name").agg(F.count("*").alias("n_orders"), F.round(revenue, 2).alias("revenue"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def cube_report(t, spark, sf_dir):
    return t("lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
