"""Named queries over nested records, tails and record files, each with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import nested, shapes, text
from corpusloom.operators import records
from corpusloom.plans.catalog import query
from corpusloom.sources import lines
from corpusloom.streaming.events import working_folder


def _timelines(t):
    return t("documents").select("doc_id", nested.timeline(F.col("text"), F.coalesce("lang", F.lit("?"))).alias("turns"))


@query("""SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x: coalesce(lang, '?') || ': ' || x), chr(10)) AS transcript FROM documents""")
def timeline_transcript(t, spark, sf_dir):
    said = F.transform(nested.transcript(F.col("turns")), lambda x: F.concat_ws(": ", x["speaker"], x["text"]))
    return _timelines(t).select("doc_id", F.array_join(said, "\n").alias("transcript"))


@query("""SELECT doc_id, unnest(range(len(s))) AS turn, unnest(s) AS utterance FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)""")
def unnest_turns(t, spark, sf_dir):
    return _timelines(t).select("doc_id", F.inline("turns")).select("doc_id", "turn", "utterance")


@query("""SELECT doc_id, sha256(array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: (i - 1) || chr(9) || coalesce(lang, '?') || chr(9) || x), chr(10))) AS digest FROM documents""")
def timeline_digest(t, spark, sf_dir):
    return _timelines(t).select("doc_id", nested.timeline_digest(F.col("turns")).alias("digest"))


@query("""SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10))[-3:],
  lambda x: CASE WHEN len(x) > 60 THEN substr(x, 1, 60) || '... [truncated ' || (len(x) - 60) || ' chars]' ELSE x END), chr(10)) AS shown FROM documents""")
def bounded_record(t, spark, sf_dir):
    texts = F.transform("turns", lambda x: x["utterance"])
    return _timelines(t).select("doc_id", F.array_join(nested.bounded(texts, 3, 60), "\n").alias("shown"))


@query("""SELECT event_id, '{"user_id":' || user_id || ',"what":{"event_type":"' || event_type || '"}}' AS record FROM events""")
def drop_listed_fields(t, spark, sf_dir):
    record = F.struct("user_id", F.struct("event_type", "props").alias("what"), F.col("value").alias("amount"))
    return t("events").select("event_id", F.to_json(record.dropFields("what.props", "amount")).alias("record"))


@query("""SELECT event_type, sum(k)::BIGINT AS prompt_tokens, sum(user_id)::BIGINT AS total_tokens, sum(k)::BIGINT AS reasoning_tokens
FROM (SELECT *, try_cast(regexp_extract(props, '"k": (-?[0-9]+)', 1) AS BIGINT) AS k FROM events) GROUP BY event_type""")
def usage_totals(t, spark, sf_dir):
    report = F.to_json(F.struct(
        F.get_json_object("props", "$.k").try_cast("bigint").alias("prompt_tokens"), F.col("user_id").alias("total_tokens"), F.lit("x").alias("note"),
        F.struct(F.get_json_object("props", "$.k").try_cast("bigint").alias("reasoning_tokens")).alias("completion_tokens_details"),
    ))
    used = t("events").select("event_type", nested.usage(report).alias("u"))
    return used.groupBy("event_type").agg(*(F.sum(f"u.{c}").alias(c) for c in ("prompt_tokens", "total_tokens", "reasoning_tokens")))


@query("""SELECT doc_id, sha256(text) = sha256(trim(regexp_replace(regexp_replace(text, '[\\r\\n]', ' ', 'g'), ' {2,}', ' ', 'g'))) AS reused FROM documents""")
def signature_gate(t, spark, sf_dir):
    signature, made = text.sha256(F.col("text")), text.sha256(text.normalize(F.col("text")))
    return t("documents").select("doc_id", (signature == made).alias("reused"))


@query("""SELECT doc_id, CASE WHEN doc_id < (SELECT count(*) FROM labels) THEN 'initial' ELSE 'generated' END AS origin, doc_id < (SELECT count(*) FROM labels WHERE toxic = 0) AS likely_consumed FROM documents""")
def origin_flags(t, spark, sf_dir):
    initial = t("labels").agg(F.count("*")).scalar()
    consumed = t("labels").agg(F.count_if(F.col("toxic") == 0)).scalar()
    return records.origins(t("documents").select("doc_id"), "doc_id", initial, consumed)


@query("""SELECT event_id, user_id FROM events ORDER BY event_id DESC LIMIT 200""")
def tail_cold_start(t, spark, sf_dir):
    return records.tail(t("events").select("event_id", "user_id"), "event_id", None)


@query("""SELECT doc_id FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 25""")
def sample_without_replacement(t, spark, sf_dir):
    return records.sampled(t("documents").select("doc_id"), "doc_id", 25, 7)


@query("SELECT doc_id, lang, sha256(text) AS sha256 FROM documents")
def jsonl_round_trip(t, spark, sf_dir):
    folder = working_folder(spark)
    rows = t("documents").select("doc_id", "lang", "text")
    lines.append_jsonl(rows, folder)
    return lines.read_jsonl_strict(spark, folder, rows.schema).select("doc_id", "lang", F.sha2("text", 256).alias("sha256"))


@query("""SELECT CASE event_type WHEN 'click' THEN 'not JSON' WHEN 'view' THEN 'not an object' ELSE 'record' END AS kind, count(*) AS n FROM events GROUP BY 1""")
def dead_letters(t, spark, sf_dir):
    folder = working_folder(spark)
    kind = F.col("event_type")
    line = F.when(kind == "click", F.expr("left(props, length(props) - 1)")).when(kind == "view", F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.col("props"))
    t("events").select(line.alias("value")).write.text(folder)
    good, bad = lines.read_jsonl_lenient(spark, folder, T.StructType().add("k", "long"))
    return good.select(F.lit("record").alias("kind")).unionByName(bad.select(F.col("reason").alias("kind"))).groupBy("kind").agg(F.count("*").alias("n"))


@query("""SELECT conv_id, stage, turn, text FROM (
  SELECT conv_id, 'said' AS stage, turn, text FROM conversations WHERE role <> 'system' UNION ALL
  SELECT conv_id, 'set', turn, text FROM conversations WHERE role = 'system')""")
def unnest_stages(t, spark, sf_dir):
    """Two histories of a record, each an array, unnested under one label column."""
    turn = F.struct("turn", "text")
    rows = t("conversations").groupBy("conv_id").agg(
        F.collect_list(F.when(F.col("role") != "system", turn)).alias("said"), F.collect_list(F.when(F.col("role") == "system", turn)).alias("set")
    )
    return nested.unnest_stages(rows, ["conv_id"], ["said", "set"])


def _three_levels(t):
    """Turns as records: a map by role of the words, each with its place, a note and its secret, beside where it is from."""
    said = F.transform(F.split("text", " "), lambda w, i: F.struct(i.cast("bigint").alias("at"), w.alias("word"), F.struct(F.lit("s").alias("secret"), (i * 2).cast("bigint").alias("twice")).alias("note")))
    source = F.struct(F.col("turn").alias("turn"), F.lit("s").alias("secret"))
    return t("conversations").filter("text IS NOT NULL AND role IS NOT NULL").select("conv_id", "turn", "role", F.struct(F.create_map("role", said).alias("said"), source.alias("source")).alias("record"))


@query("""SELECT conv_id, turn, list_transform(string_split(text, ' ')[-3:], lambda w: CASE WHEN len(w) > 4 THEN w[1:4] || '... [truncated ' || (len(w) - 4) || ' chars]' ELSE w END) AS words
FROM conversations WHERE text IS NOT NULL AND role IS NOT NULL""")
def record_bounded(t, spark, sf_dir):
    """The last three words of each turn's record, clipped where they stand, three levels down."""
    rows = _three_levels(t)
    cut = shapes.bounded_shape(F.col("record"), rows.schema["record"].dataType, keep=3, chars=4)
    return rows.select("conv_id", "turn", F.transform(cut["said"][F.col("role")], lambda x: x["word"]).alias("words"))


@query("""SELECT conv_id, turn, CASE WHEN role = 'system' THEN '{"said":{},"source":{"turn":' || turn || '}}' ELSE
  '{"said":{"' || role || '":[' || array_to_string(list_transform(range(len(string_split(text, ' '))), lambda i: '{"at":' || i || ',"note":{"twice":' || 2 * i || '}}'), ',') || ']},"source":{"turn":' || turn || '}}' END AS record
FROM conversations WHERE text IS NOT NULL AND role IS NOT NULL""")
def paths_dropped(t, spark, sf_dir):
    """Records without their secrets at any depth, without words, and without what the system said."""
    rows = _three_levels(t)
    cut = shapes.bounded_shape(F.col("record"), rows.schema["record"].dataType, drop=("**.secret", "said.*.[].word", "said.system"))
    return rows.select("conv_id", "turn", F.to_json(cut).alias("record"))
