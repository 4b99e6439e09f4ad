"""Named queries with lookups, set operations, ranks and event windows, each with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.operators import records, sketches, taggers
from corpusloom.plans.catalog import query
from corpusloom.streaming import events as streaming


@query("SELECT d.doc_id, d.source, l.quality FROM documents d JOIN labels l USING (doc_id)")
def keyed_lookup(t, spark, sf_dir):
    return t("documents").select("doc_id", "source").join(t("labels").select("doc_id", "quality"), "doc_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def id_set_filter(t, spark, sf_dir):
    return t("documents").select("doc_id", "lang").join(t("labels").filter("toxic = 1"), "doc_id", "left_semi")


@query("SELECT event_id FROM events WHERE event_type <> 'purchase'")
def status_filter(t, spark, sf_dir):
    return t("events").filter("event_type <> 'purchase'").select("event_id")


@query("SELECT o_custkey AS k FROM orders EXCEPT ALL SELECT c_custkey FROM customer")
def key_difference(t, spark, sf_dir):
    return t("orders").select(F.col("o_custkey").alias("k")).exceptAll(t("customer").select("c_custkey"))


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def key_intersection(t, spark, sf_dir):
    return t("customer").select(F.col("c_nationkey").alias("k")).intersect(t("supplier").select("s_nationkey"))


@query("SELECT 'customer' AS kind, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_name FROM supplier")
def union_append(t, spark, sf_dir):
    customers = t("customer").select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"))
    return customers.unionByName(t("supplier").select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name")))


@query("""SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)""")
def rollup_report(t, spark, sf_dir):
    return t("orders").rollup("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))


@query("""SELECT c_custkey, rank() OVER w AS place, dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey) AS level,
  ntile(4) OVER w AS quarter, lead(c_custkey) OVER w AS following
FROM customer WINDOW w AS (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey)""")
def ranks(t, spark, sf_dir):
    by = Window.partitionBy("c_mktsegment").orderBy(F.desc("c_acctbal"), "c_custkey")
    levels = Window.partitionBy("c_mktsegment").orderBy("c_nationkey")
    return t("customer").select(
        "c_custkey", F.rank().over(by).cast("bigint").alias("place"), F.dense_rank().over(levels).cast("bigint").alias("level"),
        F.ntile(4).over(by).cast("bigint").alias("quarter"), F.lead("c_custkey").over(by).alias("following"),
    )


@query("""SELECT start, count(*) AS n FROM (
  SELECT unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS start FROM events) GROUP BY start""")
def sliding_windows(t, spark, sf_dir):
    rows = streaming.sliding(t("events"), "1 hour", "30 minutes")
    return rows.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


@query("""SELECT user_id, min(ts) AS start, count(*) AS n FROM (
  SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM (
    SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events))
GROUP BY user_id, s""")
def session_windows(t, spark, sf_dir):
    rows = streaming.sessions(t("events"), "user_id", "6 hours")
    return rows.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


@query("""SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n <= 5""")
def bounded_state_stream(t, spark, sf_dir):
    source = streaming.growing(spark, sf_dir, t("events").schema, "events.parquet").select("event_id", "user_id", "ts")
    return streaming.keep_last(source, ["user_id"], ["ts", "event_id"], 5, streaming.working_folder(spark)).select("event_id", "user_id")


@query("""SELECT doc_id, quality FROM labels WHERE doc_id NOT IN (SELECT doc_id * 2 FROM labels)""")
def keys_deleted(t, spark, sf_dir):
    gone = t("labels").select((F.col("doc_id") * 2).alias("doc_id"))
    return records.delete_by_key(t("labels").select("doc_id", "quality"), gone, "doc_id")


@query("""SELECT user_id, row_number() OVER (ORDER BY user_id) AS place FROM events GROUP BY user_id HAVING count(*) > 1""")
def duplicate_ids_sorted(t, spark, sf_dir):
    several = t("events").groupBy("user_id").count().filter("count > 1").select("user_id")
    return records.numbered(several, [F.col("user_id")], "place", streaming.working_folder(spark))


@query("""SELECT conv_id, greatest(CASE WHEN conv_id % 3 = 0 THEN conv_id % 10 END, count(*), CASE WHEN conv_id % 2 = 0 THEN 3 END)::BIGINT AS n FROM conversations GROUP BY conv_id""")
def turns_counted(t, spark, sf_dir):
    """The most of a stated number, the timeline's size and the turns' size, each of which may be missing."""
    rows = t("conversations").groupBy("conv_id").agg(F.count("*").alias("timeline"))
    stated = F.when(F.col("conv_id") % 3 == 0, F.col("conv_id") % 10)
    turns = F.when(F.col("conv_id") % 2 == 0, F.lit(3))
    return rows.select("conv_id", records.most_of(stated, F.col("timeline"), turns).cast("bigint").alias("n"))


@query("""SELECT e.event_id, e.user_id, v.value AS seen FROM (SELECT * FROM events WHERE event_type = 'purchase') e
ASOF LEFT JOIN (SELECT user_id, ts, arg_max(value, event_id) AS value FROM events WHERE event_type = 'view' GROUP BY user_id, ts) v ON e.user_id = v.user_id AND e.ts >= v.ts""")
def as_of_join(t, spark, sf_dir):
    bought = t("events").filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    viewed = t("events").filter("event_type = 'view'").groupBy("user_id", "ts").agg(F.max_by("value", "event_id").alias("seen"))
    return records.as_of(bought, viewed, ["user_id"], "ts", "seen").select("event_id", "user_id", "seen")


@query("""SELECT p_partkey, s_suppkey FROM part JOIN supplier ON p_retailprice >= s_acctbal / 10 AND p_retailprice < s_acctbal / 10 + 50""")
def range_join(t, spark, sf_dir):
    ranges = t("supplier").select("s_suppkey", (F.col("s_acctbal") / 10).alias("begin"), (F.col("s_acctbal") / 10 + 50).alias("end"))
    found = records.in_ranges(t("part").select("p_partkey", "p_retailprice"), ranges, "p_retailprice", "begin", "end", 50.0)
    return found.select("p_partkey", "s_suppkey")


@query("""SELECT event_type, count(DISTINCT user_id) AS users, true AS users_near, true AS median_near FROM events GROUP BY event_type""")
def approximate_counts(t, spark, sf_dir):
    """Sketches beside exact figures: within a tenth in number, and within a twentieth in rank."""
    exact = t("events").groupBy("event_type").agg(
        F.count_distinct("user_id").alias("users"), F.approx_count_distinct("user_id", 0.02).alias("about"),
        F.percentile_approx("value", 0.5, 1000).alias("middle"), F.percentile("value", F.array(F.lit(0.45), F.lit(0.55))).alias("around"),
    )
    near = F.abs(F.col("about") - F.col("users")) <= F.greatest(F.lit(1), F.col("users") / 10)
    return exact.select("event_type", "users", near.alias("users_near"), F.col("middle").between(F.col("around")[0], F.col("around")[1]).alias("median_near"))


@query("""SELECT o_orderkey, year(o_orderdate) AS y, date_trunc('month', o_orderdate)::DATE AS month, date_diff('day', DATE '1992-01-01', o_orderdate::DATE) AS days, sqrt(floor(o_totalprice)) AS root FROM orders""")
def dates_and_numbers(t, spark, sf_dir):
    return t("orders").select(
        "o_orderkey", F.year("o_orderdate").cast("bigint").alias("y"), F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"),
        F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("bigint").alias("days"), F.sqrt(F.floor("o_totalprice")).alias("root"),
    )


@query("""SELECT c_mktsegment, count(*) AS n, sum(b) AS balance FROM (SELECT c_mktsegment, floor(c_acctbal)::BIGINT AS b FROM customer) GROUP BY c_mktsegment""")
def map_totals(t, spark, sf_dir):
    """Counters under dynamic keys: each row is a map, and its entries are added up by key."""
    entries = F.create_map(F.col("c_mktsegment"), F.floor("c_acctbal").cast("bigint"))
    rows = t("customer").select(F.explode(entries).alias("c_mktsegment", "b"))
    return rows.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.sum("b").alias("balance"))


@query("""WITH words AS (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS k FROM benchmark), texts AS (SELECT DISTINCT text FROM documents),
found AS (SELECT text, count(*) AS n_tags, array_to_string(list(k ORDER BY len(k) DESC, k)[1:5], ' ') AS tags FROM texts JOIN words ON k <> '' AND contains(lower(text), k) GROUP BY text)
SELECT doc_id, coalesce(n_tags, 0) AS n_tags, coalesce(tags, '') AS tags FROM documents LEFT JOIN found USING (text)""")
def dictionary_tags(t, spark, sf_dir):
    """Documents with the words of the benchmark that they hold, the longest five of them by name."""
    words = t("benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("word")).filter("word <> ''")
    docs, folder = t("documents").select("doc_id", "text"), streaming.working_folder(spark)
    found = taggers.dictionary_tags(docs, F.col("text"), words, F.col("word"), -F.length("word"), folder, 5, count="n_tags")
    return found.select("doc_id", "n_tags", F.array_join("tags", " ").alias("tags"))


@query("""SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, true AS users_near, true AS quantiles_near FROM events GROUP BY event_type""")
def sketched_counts(t, spark, sf_dir):
    """Two arrivals of events as daily sketches, merged by type, beside exact figures: four standard errors, a fiftieth in rank."""
    events = t("events").select("event_id", "event_type", "ts", "user_id", "value")
    table = sketches.SketchTable(spark, streaming.working_folder(spark), F.col("ts"), ["event_type"], {"users": F.col("user_id")}, {"middle": F.col("value")})
    for part in (0, 1):
        table.append(events.filter(F.pmod("event_id", F.lit(2)) == part))
    ranks = [0.1, 0.5, 0.9]
    about = table.figures(table.merged(["event_type"]), ranks).withColumnRenamed("users", "about")
    around = F.percentile("value", F.array(*(F.lit(r + d) for r in ranks for d in (-0.02, 0.02)))).alias("around")
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), around)
    near = F.abs(F.col("about") - F.col("users")) <= F.greatest(F.lit(1.0), 4 * sketches.count_error(table.lg_k) * F.col("users"))
    held = F.lit(True)
    for i in range(len(ranks)):
        held &= F.col("middle")[i].between(F.col("around")[2 * i], F.col("around")[2 * i + 1])
    return about.join(exact, "event_type").select("event_type", "n", "users", near.alias("users_near"), held.alias("quantiles_near"))


@query("""WITH days AS (SELECT DISTINCT ts::DATE AS day FROM events)
SELECT day, count(*) AS n, count(DISTINCT user_id) AS users, true AS users_near FROM days JOIN events ON ts::DATE <= day AND ts::DATE > day - 7 GROUP BY day""")
def trailing_users(t, spark, sf_dir):
    """Users of the seven days up to each day: merged daily sketches, beside the exact figure."""
    events = t("events").select("ts", "user_id")
    table = sketches.SketchTable(spark, streaming.working_folder(spark), F.col("ts"), [], {"about": F.col("user_id")}, {})
    table.append(events)
    days = events.select(F.col("ts").cast("date").alias("day"), "user_id").distinct()
    sent = days.select(F.explode(F.expr("transform(sequence(0, 6), i -> date_add(day, i))")).alias("day"), "user_id")
    exact = sent.groupBy("day").agg(F.count_distinct("user_id").alias("users"))
    near = F.abs(F.col("about") - F.col("users")) <= F.greatest(F.lit(1.0), 4 * sketches.count_error(table.lg_k) * F.col("users"))
    return table.figures(table.trailing(7)).join(exact, "day").select("day", "n", "users", near.alias("users_near"))
