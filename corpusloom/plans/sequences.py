"""Named queries over sequences whose keys may be hot, by segmented scans; each with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import segments
from corpusloom.plans.catalog import query
from corpusloom.streaming import events as streaming


@query("""SELECT event_id, event_type, last_value(CASE WHEN value > 60 THEN value END IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS latest FROM events""")
def latest_state_by_ranges(t, spark, sf_dir):
    events = t("events").select("event_id", "event_type", "ts", "value")
    high = F.when(F.col("value") > 60, F.col("value"))
    found = segments.latest_known(events, ["event_type"], ["ts", "event_id"], high, "latest", streaming.working_folder(spark))
    return found.select("event_id", "event_type", "latest")


@query("""SELECT event_id, event_type, list(event_id) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS recent FROM events""")
def recent_k_by_ranges(t, spark, sf_dir):
    events = t("events").select("event_id", "event_type", "ts")
    found = segments.recent_same(events, ["event_type"], ["ts", "event_id"], "event_id", 5, streaming.working_folder(spark))
    return found.select("event_id", "event_type", F.when(F.size("recent") > 0, F.col("recent")).alias("recent"))


@query("""SELECT source, lang, min(doc_id) AS run_start, count(*) AS run_length FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS island FROM documents)
GROUP BY source, lang, island""")
def runs_by_ranges(t, spark, sf_dir):
    return segments.runs(t("documents"), ["source"], "doc_id", "lang", streaming.working_folder(spark))


@query("""SELECT doc_id, source, lang FROM (
  SELECT *, lead(lang) OVER w AS following, lead(1) OVER w AS more FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id))
WHERE more IS NULL OR following IS DISTINCT FROM lang""")
def collapse_by_ranges(t, spark, sf_dir):
    docs = t("documents").select("doc_id", "source", "lang")
    return segments.collapse_repeats(docs, ["source"], ["doc_id"], ["lang"], streaming.working_folder(spark))


@query("""SELECT e.event_id, e.event_type, p.value AS paid FROM (SELECT * FROM events WHERE event_type <> 'purchase') e
ASOF LEFT JOIN (SELECT ts, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY ts) p ON e.ts >= p.ts""")
def as_of_by_ranges(t, spark, sf_dir):
    """Each event with the last purchase of anyone: one key has all rows."""
    events = t("events").withColumn("all", F.lit(1))
    paid = events.filter("event_type = 'purchase'").groupBy("all", "ts").agg(F.max("value").alias("paid"))
    asks = events.filter("event_type <> 'purchase'").select("all", "ts", "event_id", "event_type")
    found = segments.as_of(asks, paid, ["all"], "ts", "paid", streaming.working_folder(spark))
    return found.select("event_id", "event_type", "paid")
