"""Named queries over streams: late rows, sliding and session windows, the active set; each with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import records
from corpusloom.plans.catalog import query
from corpusloom.sources.tail import tail
from corpusloom.streaming import events as streaming
from corpusloom.streaming import state


@query("""WITH first AS (SELECT * FROM events WHERE event_type = 'purchase'), mark AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 3 DAY AS w FROM first),
seen AS (SELECT ts, value FROM first UNION ALL SELECT ts, value FROM events, mark WHERE event_type <> 'purchase' AND time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR > w)
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS n FROM seen GROUP BY 1""")
def late_rows_dropped(t, spark, sf_dir):
    """Purchases arrive first and move the watermark; what then comes for windows that ended three days before is dropped."""
    folder = streaming.working_folder(spark)
    events = t("events").select("ts", "event_type", "value")
    for part in (events.filter("event_type = 'purchase'"), events.filter("event_type <> 'purchase'")):
        part.write.mode("append").parquet(f"{folder}/in")
        stream = streaming.growing(spark, f"{folder}/in", events.schema, files=1_000_000)
        bounded = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "3 days")
        counts = bounded.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"))
        out = streaming.updated(counts, F.col("w"), folder)
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


@query("""SELECT start, count(*) AS n FROM (
  SELECT unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS start FROM events) GROUP BY start""")
def sliding_stream(t, spark, sf_dir):
    source = streaming.growing(spark, sf_dir, t("events").schema, "events.parquet", files=1_000_000)
    counts = streaming.sliding(source, "1 hour", "30 minutes", late="2 days")  # one batch, so nothing is late
    out = streaming.updated(counts, F.col("w"), streaming.working_folder(spark))
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


@query("""SELECT user_id, min(ts) AS start, count(*) AS n FROM (
  SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM (
    SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events))
GROUP BY user_id, s""")
def session_stream(t, spark, sf_dir):
    """Each session is given out once, when the watermark has passed it, and leaves the state; a mark of the end lets the last ones go."""
    folder = streaming.working_folder(spark)
    events = t("events").select("user_id", "ts")
    for part in (events, _end(events)):
        part.write.mode("append").parquet(f"{folder}/in")
        source = streaming.growing(spark, f"{folder}/in", events.schema, files=1_000_000)
        streaming.drain(streaming.sessions(source, "user_id", "6 hours", late="2 days"), folder)
    return spark.read.parquet(f"{folder}/rows").select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


def _end(rows):
    """A row with nothing but a time long after all others."""
    last = rows.agg((F.max("ts") + F.expr("INTERVAL 60 DAY")).alias("ts"))
    return last.select(*(F.col("ts") if c == "ts" else F.lit(None).cast(kind).alias(c) for c, kind in rows.dtypes))


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1 AND event_type <> 'purchase'""")
def active_set_stream(t, spark, sf_dir):
    """Keys whose last event isn't a purchase, from a stream in two arrivals in order of time; done keys leave the state."""
    folder = streaming.working_folder(spark)
    events = t("events").select("event_id", "user_id", "ts", "event_type")
    middle = events.agg(F.expr("min(ts) + (max(ts) - min(ts)) / 2")).scalar()
    for part in (events.filter(F.col("ts") < middle), events.filter(F.col("ts") >= middle)):
        part.write.mode("append").parquet(f"{folder}/in")
        stream = streaming.growing(spark, f"{folder}/in", events.schema, files=1_000_000)
        out = streaming.keep_last(stream, ["user_id"], ["ts", "event_id"], 1, folder, keep=F.col("event_type") != "purchase")
    return out.select("user_id", "event_id", "event_type")


@query("""SELECT p.event_id AS purchase_id, v.event_id AS view_id FROM events p JOIN events v ON p.user_id = v.user_id AND v.ts >= p.ts - INTERVAL 6 HOUR AND v.ts <= p.ts
WHERE p.event_type = 'purchase' AND v.event_type = 'view'""")
def interval_join_stream(t, spark, sf_dir):
    """Purchases with what the same user has viewed in the six hours before, from two streams; old rows leave the state of both."""
    folder = streaming.working_folder(spark)
    source = lambda: streaming.growing(spark, sf_dir, t("events").schema, "events.parquet")
    bought = streaming.told(source(), F.col("event_type") == "purchase", "2 days").select(F.col("user_id").alias("buyer"), F.col("ts").alias("bought"), F.col("event_id").alias("purchase_id"))
    viewed = streaming.told(source(), F.col("event_type") == "view", "2 days").select("user_id", F.col("ts").alias("seen"), F.col("event_id").alias("view_id"))
    streaming.drain(streaming.within(bought, viewed, F.col("buyer") == F.col("user_id"), "bought", "seen", "6 hours"), folder)
    return spark.read.parquet(f"{folder}/rows").select("purchase_id", "view_id")


@query("""SELECT p.event_id AS purchase_id, v.event_id AS view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v
ON p.user_id = v.user_id AND v.ts >= p.ts - INTERVAL 6 HOUR AND v.ts <= p.ts""")
def outer_join_stream(t, spark, sf_dir):
    """Purchases with what the user has viewed in the six hours before, or with null, once; the streams come in three arrivals."""
    folder = streaming.working_folder(spark)
    events = t("events").select("event_id", "user_id", "ts", "event_type")
    middle = events.agg(F.expr("min(ts) + (max(ts) - min(ts)) / 2")).scalar()
    ends = _end(events)
    # A mark for either stream, with a user, as rows without one are left out before their time is seen.
    mark = lambda kind, user: ends.withColumn("event_type", F.lit(kind)).withColumn("user_id", F.lit(user).cast("bigint"))
    ends = mark("purchase", -1).unionByName(mark("view", -2))
    for part in (events.filter(F.col("ts") < middle), events.filter(F.col("ts") >= middle), ends):
        part.write.mode("append").parquet(f"{folder}/in")
        source = lambda: streaming.growing(spark, f"{folder}/in", events.schema, files=1_000_000)
        bought = streaming.told(source(), F.col("event_type") == "purchase", "1 day").select(F.col("user_id").alias("buyer"), F.col("ts").alias("bought"), F.col("event_id").alias("purchase_id"))
        viewed = streaming.told(source(), F.col("event_type") == "view", "1 day").select("user_id", F.col("ts").alias("seen"), F.col("event_id").alias("view_id"))
        streaming.drain(streaming.within_or_alone(bought, viewed, F.col("buyer") == F.col("user_id"), "bought", "seen", "6 hours"), folder)
    return spark.read.parquet(f"{folder}/rows").filter("purchase_id IS NOT NULL").select("purchase_id", "view_id")


@query("""WITH mid AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS m FROM events), edge AS (SELECT max(ts) AS e FROM events, mid WHERE ts < m)
SELECT event_id, ts FROM events UNION ALL SELECT event_id, e AS ts FROM events, edge WHERE ts < e - INTERVAL 6 HOUR""")
def repeats_dropped_stream(t, spark, sf_dir):
    """Events come again in a second arrival: those of the last hour are known and go, those whose key was given up count as new."""
    folder = streaming.working_folder(spark)
    events = t("events").select("event_id", "ts")
    middle = events.agg(F.expr("min(ts) + (max(ts) - min(ts)) / 2")).scalar()
    first = events.filter(F.col("ts") < middle)
    edge = first.agg(F.max("ts")).scalar()
    again = first.filter(F.col("ts") >= edge - F.expr("INTERVAL 1 HOUR")).unionByName(first.filter(F.col("ts") < edge - F.expr("INTERVAL 6 HOUR")).withColumn("ts", edge))
    for part in (first, events.filter(F.col("ts") >= middle).unionByName(again)):
        part.write.mode("append").parquet(f"{folder}/in")
        source = streaming.growing(spark, f"{folder}/in", events.schema, files=1_000_000)
        streaming.drain(streaming.without_repeats(source, ["event_id"], "2 hours"), folder)
    return spark.read.parquet(f"{folder}/rows").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("""SELECT event_id, user_id FROM events WHERE event_id > 900""")
def tail_resumed(t, spark, sf_dir):
    return records.tail(t("events").select("event_id", "user_id"), "event_id", 900)


def _arrivals(t, spark, folder):
    """The events in two arrivals in order of time: each time, the stream of what has come so far."""
    events = t("events").select("event_id", "user_id", "ts", "event_type")
    middle = events.agg(F.expr("min(ts) + (max(ts) - min(ts)) / 2")).scalar()
    for part in (events.filter(F.col("ts") < middle), events.filter(F.col("ts") >= middle)):
        part.write.mode("append").parquet(f"{folder}/in")
        yield streaming.growing(spark, f"{folder}/in", events.schema, files=1_000_000)


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1 AND event_type <> 'purchase'""")
def active_set_state(t, spark, sf_dir):
    """The active set in the state store: a query that is started again in the middle; done keys leave the state behind the watermark."""
    folder = streaming.working_folder(spark)
    for stream in _arrivals(t, spark, folder):
        marked = stream.withColumn("done", F.col("event_type") == "purchase")
        out = state.active_keys(marked, "user_id", ["ts", "event_id"], "done", "ts", "1 hour", folder)
    return out.select("user_id", "event_id", "event_type")


@query("""SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n <= 3""")
def last_k_state(t, spark, sf_dir):
    """The last three events of each user as lists in the state store."""
    folder = streaming.working_folder(spark)
    for stream in _arrivals(t, spark, folder):
        rows = stream.withColumn("ts", F.col("ts").cast("timestamp"))
        out = state.last_rows(rows, "user_id", ["ts", "event_id"], 3, folder)
    return out.select("event_id", "user_id")


@query("""SELECT event_id, user_id FROM events WHERE event_id > (SELECT max(event_id) FROM events WHERE event_id < (SELECT max(event_id) // 2 FROM events)) - 200""")
def tail_stream(t, spark, sf_dir):
    """A tail that starts cold on half of the events and goes on from its checkpoint when the others have come."""
    folder = streaming.working_folder(spark)
    events = t("events").select("event_id", "user_id")
    half = events.agg(F.floor(F.max("event_id") / 2)).scalar()
    for part in (events.filter(F.col("event_id") < half), events.filter(F.col("event_id") >= half)):
        part.write.mode("append").parquet(f"{folder}/in")
        streaming.drain(tail(spark, f"{folder}/in", events.schema, "event_id"), folder)
    return spark.read.parquet(f"{folder}/rows")
