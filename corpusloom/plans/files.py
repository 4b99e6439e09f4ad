"""Named queries over record files: line numbers, versions, pages of lines, dead letters, lenient JSON; each with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import jsontext
from corpusloom.functions import text as texts
from corpusloom.operators import records
from corpusloom.plans.catalog import query
from corpusloom.sources import formats, keyed, lineindex, lines
from corpusloom.streaming.events import working_folder


@query("""SELECT 3 * n_nationkey + 2 AS line_number, n_name AS text, sha256(n_name) AS sha256 FROM nation""")
def line_scan(t, spark, sf_dir):
    """A file with a comment, a name and a blank line for each nation."""
    folder = working_folder(spark)
    line = F.explode(F.array(F.lit("# next"), F.concat(F.lit("  "), "n_name", F.lit("\t")), F.lit(" ")))
    t("nation").repartition(1).sortWithinPartitions("n_nationkey").select(line.alias("value")).write.text(folder)
    return lines.read_lines(spark, folder)


@query("""SELECT 'there' AS file, 3 * count(*) AS n_lines, count(*) AS n_texts FROM nation UNION ALL SELECT 'missing', 0, 0""")
def line_counts(t, spark, sf_dir):
    folder = working_folder(spark)
    t("nation").select(F.explode(F.array(F.lit("# next"), "n_name", F.lit(""))).alias("value")).write.text(folder)
    out = [(name, lines.count_lines(spark, at), lines.read_lines_if_there(spark, at).count()) for name, at in (("there", folder), ("missing", f"{folder}-none"))]
    return spark.createDataFrame(out, "file string, n_lines long, n_texts long")


@query("""SELECT 'current' AS kind, doc_id, quality + 1 AS quality FROM labels UNION ALL SELECT 'backup', doc_id, quality FROM labels""")
def versioned_rewrite(t, spark, sf_dir):
    """A table that is rewritten from its own current version; both versions are read back."""
    store = lines.Versions(spark, working_folder(spark))
    rows = t("labels").select("doc_id", "quality")
    first = store.replace(rows)
    store.replace(store.read(rows.schema).withColumn("quality", F.col("quality") + 1))
    current = store.read(rows.schema).select(F.lit("current").alias("kind"), "*")
    return current.unionByName(store.read(rows.schema, first).select(F.lit("backup").alias("kind"), "*"))


@query("""SELECT event_id, (SELECT count(*) FROM events) AS total FROM (SELECT * FROM events ORDER BY event_id DESC LIMIT 50 OFFSET 20) WHERE event_type NOT IN ('click', 'view')""")
def page_of_lines(t, spark, sf_dir):
    """Some lines are cut short and some are arrays, so the page is short."""
    kind = F.col("event_type")
    line = F.when(kind == "click", F.expr("left(props, length(props) - 1)")).when(kind == "view", F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.col("props"))
    return records.page_of_lines(t("events").select("event_id", line.alias("line")), "event_id", "line", 20, 50).select("event_id", "total")


@query("""SELECT '2024-05-01T10:20:30+00:00' AS created_at, 2 AS attempt, CASE event_type WHEN 'click' THEN 'not_JSON' ELSE 'not_an_object' END AS error_type,
  CASE event_type WHEN 'click' THEN 'not JSON: ' || left(props, len(props) - 1) ELSE 'not an object: [' || props || ']' END AS error, '{"source":"events"}' AS context
FROM events WHERE event_type IN ('click', 'view')""")
def dead_letter_log(t, spark, sf_dir):
    folder = working_folder(spark)
    kind = F.col("event_type")
    line = F.when(kind == "click", F.expr("left(props, length(props) - 1)")).when(kind == "view", F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.col("props"))
    t("events").select(line.alias("value")).write.text(folder)
    _, bad = lines.read_jsonl_lenient(spark, folder, T.StructType().add("k", "long"))
    return lines.dead_letters(bad, 2, {"source": "events"}, F.lit("2024-05-01 10:20:30").cast("timestamp"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS at FROM events""")
def iso_times(t, spark, sf_dir):
    return t("events").select("event_id", texts.iso_utc(F.col("ts").cast("timestamp")).alias("at"))


_LENIENT = """SELECT event_id, CASE event_id % 8
  WHEN 7 THEN NULL ELSE '{"a": [1, {"k": ' || n || '}], "t": "x, y"}' END AS value
FROM (SELECT event_id, regexp_extract(props, '"k": (-?[0-9]+)', 1) AS n FROM events)"""


@query(_LENIENT)
def lenient_records(t, spark, sf_dir):
    """One record in eight shapes: bare, fenced, in prose, four ways without commas, and beyond repair."""
    good = F.concat(F.lit('{"t": "x, y", "a": [1, '), "props", F.lit("]}"))
    broken = [
        F.concat(F.lit('{"t": "x, y"\n "a": [1, '), "props", F.lit("]}")),
        F.concat(F.lit('{"t": "x, y" "a": [1, '), "props", F.lit("]}")),
        F.concat(F.lit('{"a": [1 '), "props", F.lit('] "t": "x, y"}')),
        F.concat(F.lit('So: {"a": [1\n'), "props", F.lit(']\n"t": "x, y"} as asked')),
        F.concat(F.lit('{"t": "x, "y"", "a": [1, '), "props", F.lit("]}")),
    ]
    shapes = [good, F.concat(F.lit("```json\n"), good, F.lit("\n```")), F.concat(F.lit("The answer is "), good, F.lit(".")), *broken]
    shape = F.element_at(F.array(*shapes), (F.pmod("event_id", F.lit(8)) + 1).cast("int"))
    return t("events").select("event_id", jsontext.lenient_json(shape).alias("value"))


@query("""SELECT event_id, CASE event_id % 3 WHEN 2 THEN NULL ELSE try_cast(regexp_extract(props, '"k": (-?[0-9]+)', 1) AS BIGINT) END AS k FROM events""")
def unwrapped_records(t, spark, sf_dir):
    """An object under its key, bare, or another object altogether."""
    shapes = F.array(F.concat(F.lit('{"r": '), "props", F.lit("}")), F.col("props"), F.lit('{"z": 1}'))
    shape = F.element_at(shapes, (F.pmod("event_id", F.lit(3)) + 1).cast("int"))
    return t("events").select("event_id", jsontext.wrapped_or_bare(shape, "r", "k bigint")["k"].alias("k"))


@query("""SELECT c_custkey, c_name, c_acctbal, kind FROM customer, (VALUES ('orc'), ('csv'), ('json'), ('parquet')) v(kind)""")
def format_round_trip(t, spark, sf_dir):
    rows = t("customer").select("c_custkey", "c_name", "c_acctbal")
    out = None
    for kind in ("orc", "csv", "json", "parquet"):
        back = formats.round_trip(rows, kind, working_folder(spark)).withColumn("kind", F.lit(kind))
        out = back if out is None else out.unionByName(back)
    return out


@query("""SELECT 'a/b' AS key, '{"n": 2}' AS value UNION ALL SELECT 'c', '{"n": 3}'""")
def document_cache(t, spark, sf_dir):
    """Documents are put, replaced, deleted and looked up by key; a broken one counts as none."""
    folder = working_folder(spark)
    for key, value in (("a/b", '{"n": 1}'), ("c", '{"n": 3}'), ("d", '{"n": 4}'), ("e", "broken"), ("a/b", '{"n": 2}')):
        lines.put_document(spark, folder, key, value)
    for key in ("d", "none"):
        lines.delete_document(spark, folder, key)
    found = [lines.find_document(spark, folder, k).select(F.lit(k).alias("key"), "value") for k in ("a/b", "c", "d", "e")]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


@query("""SELECT sha256('a.json' || chr(10) || sha256('{"n": 1}') || chr(10) || 'b_c.json' || chr(10) || sha256('{"n": 2}')) AS digest""")
def folder_hash(t, spark, sf_dir):
    folder = working_folder(spark)
    for key, value in (("b c", '{"n": 2}'), ("a", '{"n": 1}')):
        lines.put_document(spark, folder, key, value)
    return spark.createDataFrame([(lines.folder_digest(spark, folder),)], "digest string")


@query("""SELECT p_partkey, array_to_string(list_filter([
  CASE WHEN lo <= 0 THEN 'min_turns must be above 0' END, CASE WHEN p_size <= 0 THEN 'max_turns must be above 0' END,
  CASE WHEN p_size < lo THEN 'max_turns is below min_turns' END], lambda x: x IS NOT NULL), ', ') AS errors
FROM (SELECT p_partkey, p_size, p_partkey % 60 - 5 AS lo FROM part)""")
def range_checks(t, spark, sf_dir):
    limits = {"min_turns": F.col("p_partkey") % 60 - 5, "max_turns": F.col("p_size")}
    return t("part").select("p_partkey", F.array_join(records.range_errors(limits), ", ").alias("errors"))


@query("""WITH fresh AS (SELECT doc_id + 40 AS doc_id, 'new' AS lang, n_chars AS pos FROM documents WHERE doc_id % 50 = 7)
SELECT 'after' AS version, doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM fresh) AND doc_id % 11 <> 3
UNION ALL SELECT 'after', doc_id, lang FROM fresh WHERE doc_id % 11 <> 3 UNION ALL SELECT 'before', doc_id, lang FROM documents""")
def merged_files(t, spark, sf_dir):
    """Documents that are merged and deleted by key in files that hold those keys; the first version is read back, too."""
    docs = t("documents").select("doc_id", "lang", F.col("n_chars").alias("pos"))
    table = keyed.KeyedFiles(spark, working_folder(spark), docs.schema, "doc_id", "pos")
    first = table.replace(docs)
    table.merge(docs.filter("doc_id % 50 = 7").select((F.col("doc_id") + 40).alias("doc_id"), F.lit("new").alias("lang"), "pos"))
    table.delete(docs.filter("doc_id % 11 = 3").unionByName(docs.select((F.col("doc_id") + 40).alias("doc_id"), "lang", "pos").filter("doc_id % 11 = 3")))
    now = table.read().select(F.lit("after").alias("version"), "doc_id", "lang")
    return now.unionByName(table.read(first).select(F.lit("before").alias("version"), "doc_id", "lang"))


@query("""WITH placed AS (SELECT event_id, event_type, count(*) OVER () AS total, row_number() OVER (ORDER BY event_id DESC) - 1 AS place FROM events)
SELECT p.page, event_id, total FROM placed JOIN (VALUES (20, 50), (400, 500)) p(page, n) ON place >= page AND place < page + n WHERE event_type NOT IN ('click', 'view')""")
def pages_by_index(t, spark, sf_dir):
    """The lines of ``page_of_lines`` in files that are indexed; two pages are read, each from the blocks that hold it."""
    folder, kind = working_folder(spark), F.col("event_type")
    line = F.when(kind == "click", F.lit("{")).when(kind == "view", F.concat(F.lit("["), "event_id", F.lit("]"))).otherwise(F.to_json(F.struct("event_id")))
    rows = t("events").repartitionByRange("event_id").sortWithinPartitions("event_id")
    rows.select(F.explode(F.array(line, F.lit(" "))).alias("value")).write.text(f"{folder}/lines")
    index = lineindex.LineIndex(spark, f"{folder}/index")
    index.extend(f"{folder}/lines")
    pages = [index.page(at, n).withColumn("page", F.lit(at)) for at, n in ((20, 50), (400, 500))]
    return pages[0].unionByName(pages[1]).select("page", F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"), "total")
