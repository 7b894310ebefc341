"""Capture selection and pacing over events: a user is a label, props the content, the time the capture's stamp."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from inkspar.operators import captures, pacing
from inkspar.operators.relational import failure_runs, page_gaps
from inkspar.plans.base import Plans
from inkspar.plans.tables import table

PLANS = Plans()

SQL_CAPTURES = """(SELECT CAST(user_id AS VARCHAR) AS label, strftime(ts, '%Y%m%d%H%M%S') AS timestamp, CAST(event_id AS VARCHAR) AS original, CASE WHEN event_id % 7 = 0 THEN '-' ELSE upper(translate(substr(md5(event_type), 1, 32), '0189', 'WXYZ')) END AS digest, 'a' || CAST(event_id AS VARCHAR) AS archive_url FROM events)"""
SQL_RANKED = f"""(SELECT *, row_number() OVER (PARTITION BY label, revision ORDER BY timestamp DESC, original DESC) AS copy FROM (SELECT *, CASE WHEN digest = '-' THEN 'url:' || archive_url ELSE digest END AS revision FROM {SQL_CAPTURES}))"""


def from_events(spark, sf_dir):
    n = F.col("event_id").cast("string")
    digest = F.when(F.col("event_id") % 7 == 0, "-").otherwise(F.upper(F.translate(F.md5("event_type"), "0189", "WXYZ")))
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("label"), F.date_format("ts", "yyyyMMddHHmmss").alias("timestamp"), n.alias("original"), digest.alias("digest"), F.concat(F.lit("a"), n).alias("archive_url"))


@PLANS.query(f"SELECT label, timestamp, original, digest FROM {SQL_RANKED} WHERE copy = 1")
def latest_per_digest(spark, sf_dir):
    return captures.newest(from_events(spark, sf_dir)).select("label", "timestamp", "original", "digest")


@PLANS.query(f"""WITH r AS (SELECT * FROM {SQL_RANKED}), f AS (SELECT label, revision, row_number() OVER (PARTITION BY label ORDER BY timestamp DESC, original DESC) AS place FROM r WHERE copy = 1)
    SELECT label, original, digest, CAST(row_number() OVER (PARTITION BY label ORDER BY f.place, copy) AS INTEGER) AS attempt FROM r JOIN f USING (label, revision)
    WHERE f.place <= 3 AND (copy = 1 OR (copy <= 3 AND regexp_full_match(digest, '[A-Z2-7]{{32}}')))""")
def topk_replay_candidates(spark, sf_dir):
    return captures.candidates(from_events(spark, sf_dir)).select("label", "original", "digest", "attempt")


@PLANS.query(f"""SELECT label, count(*) FILTER (WHERE copy = 1) AS n_captures, count(*) FILTER (WHERE copy > 1) AS n_alternates, max(timestamp || '/' || original) AS newest, string_agg(CASE WHEN copy = 1 THEN original END, ',' ORDER BY timestamp DESC, original DESC) AS listed FROM {SQL_RANKED} GROUP BY label""")
def group_collect_captures(spark, sf_dir):
    found = captures.inventory(from_events(spark, sf_dir))
    newest = F.array_max(F.transform(F.concat("captures", "alternates"), lambda c: F.concat(c["timestamp"], F.lit("/"), c["original"])))
    return found.select("label", F.size("captures").cast("bigint").alias("n_captures"), F.size("alternates").cast("bigint").alias("n_alternates"), newest.alias("newest"), F.array_join(F.transform("captures", lambda c: c["original"]), ",").alias("listed"))


@PLANS.query(f"SELECT label, arg_max(original, timestamp || '/' || original) AS original, max(timestamp) AS timestamp FROM {SQL_CAPTURES} GROUP BY label")
def max_latest(spark, sf_dir):
    return from_events(spark, sf_dir).groupBy("label").agg(F.max_by("original", F.struct("timestamp", "original")).alias("original"), F.max("timestamp").alias("timestamp"))


_RANGES = "SELECT event_id % 10 AS file, (epoch_us(ts) // 1000000 - 1704067200) * 200 AS a, (epoch_us(ts) // 1000000 - 1704067200) * 200 + 20000 + event_id % 1000 AS b FROM events"


def ranges(spark, sf_dir):
    start = (F.unix_timestamp("ts") - 1704067200) * 200
    return table(spark, sf_dir, "events").select((F.col("event_id") % 10).alias("file"), start.alias("a"), (start + 20000 + F.col("event_id") % 1000).alias("b"))


@PLANS.query(f"""WITH m AS (SELECT *, max(b) OVER (PARTITION BY file ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ({_RANGES})), g AS (SELECT *, sum(CASE WHEN reach IS NULL OR a - reach > 524288 THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS grp FROM m)
    SELECT file, min(a) AS group_start, max(b) AS group_end, count(*) AS members FROM g GROUP BY file, grp""")
def range_coalesce_gaps(spark, sf_dir):
    return captures.coalesce_gaps(ranges(spark, sf_dir), "file", "a", "b")


@PLANS.query(f"""WITH RECURSIVE o AS (SELECT file, a, b, row_number() OVER (PARTITION BY file ORDER BY a, b) AS i FROM ({_RANGES})),
    r(file, i, group_start, group_end, members) AS (SELECT file, i, a, b, 1 FROM o WHERE i = 1
        UNION ALL SELECT o.file, o.i, CASE WHEN joins THEN r.group_start ELSE o.a END, CASE WHEN joins THEN greatest(r.group_end, o.b) ELSE o.b END, CASE WHEN joins THEN r.members + 1 ELSE 1 END
        FROM (SELECT r.*, o.a, o.b, o.i AS at, o.a - r.group_end <= 524288 AND greatest(r.group_end, o.b) - r.group_start <= 20971520 AS joins FROM r JOIN o ON o.file = r.file AND o.i = r.i + 1) r JOIN o ON o.file = r.file AND o.i = r.at)
    SELECT file, group_start, max(group_end) AS group_end, CAST(max(members) AS BIGINT) AS members FROM r GROUP BY file, group_start""")
def range_coalesce(spark, sf_dir):
    return captures.coalesce_ranges(ranges(spark, sf_dir), "file", "a", "b")


@PLANS.query(f"SELECT file, CAST(sum(b - a) AS BIGINT) AS range_bytes FROM ({_RANGES}) GROUP BY file")
def sum_range_bytes(spark, sf_dir):
    return ranges(spark, sf_dir).groupBy("file").agg(F.sum(F.col("b") - F.col("a")).alias("range_bytes"))


@PLANS.query(f"""WITH c AS (SELECT * FROM {SQL_CAPTURES}), l AS (SELECT label, max(timestamp) AS latest FROM c GROUP BY label)
    SELECT c.label, original, CASE WHEN timestamp >= latest THEN 'not earlier' WHEN CAST(original AS BIGINT) % 5 = 0 THEN 'latest differs' WHEN CAST(original AS BIGINT) % 3 = 0 THEN 'no reason' END AS problem FROM c JOIN l USING (label)""")
def earlier_revision_rule(spark, sf_dir):
    rows = from_events(spark, sf_dir)
    latest = rows.groupBy("label").agg(F.max("timestamp").alias("latest"))
    n = F.col("original").cast("bigint")
    records = rows.join(latest, "label").select("label", "timestamp", "original", "digest", F.when(n % 5 == 0, "19990101000000").otherwise(F.col("latest")).alias("latest_indexed_timestamp"), F.when(n % 3 == 0, " ").otherwise("kept").alias("selection_reason"))
    return captures.earlier_revisions(records, rows).select("label", "original", "problem")


@PLANS.query("""WITH b AS (SELECT user_id, event_id, value < 30 AS bad FROM events), r AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM b), s AS (SELECT *, sum(CASE WHEN bad THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, run ORDER BY event_id) AS streak FROM r)
    SELECT event_id, CAST(streak AS BIGINT) AS streak, max(streak) OVER (PARTITION BY user_id ORDER BY event_id) >= 3 AS stopped FROM s""")
def consecutive_failures(spark, sf_dir):
    return failure_runs(table(spark, sf_dir, "events"), "user_id", "event_id", F.col("value") < 30).select("event_id", "streak", "stopped")


@PLANS.query("""SELECT user_id, event_id, CASE WHEN event_id = p THEN 'repeated' WHEN event_id <> p + 1 THEN 'gap' END AS problem FROM (SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events)""")
def pagination_gap(spark, sf_dir):
    return page_gaps(table(spark, sf_dir, "events"), "user_id", "event_id").select("user_id", "event_id", "problem")


@PLANS.query("""SELECT user_id, row_number() OVER (ORDER BY user_id % 2, user_id) AS place FROM (SELECT DISTINCT user_id FROM events) ORDER BY 2 LIMIT 20""")
def limit_n(spark, sf_dir):
    """The first of an ordered inventory; the limit is the feature."""
    firsts = table(spark, sf_dir, "events").select("user_id").distinct().orderBy(F.col("user_id") % 2, "user_id").limit(20)
    return firsts.withColumn("place", F.row_number().over(Window.orderBy(F.col("user_id") % 2, "user_id")).cast("bigint"))


@PLANS.query("SELECT DISTINCT event_type, event_type <> 'click' AS unverified FROM events ORDER BY 2, 1")
def order_verified_first(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_type", (F.col("event_type") != "click").alias("unverified")).distinct().orderBy("unverified", "event_type")


@PLANS.query("SELECT event_id, greatest(1.5, value / 10, 60.0 / (1 + event_id % 50)) AS delay FROM events")
def effective_delay(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", pacing.effective_delay(F.lit(1.5), F.col("value") / 10, F.lit(60.0), 1 + F.col("event_id") % 50).alias("delay"))


@PLANS.query("SELECT event_id, greatest(300, coalesce(try_cast(CASE WHEN event_id % 3 = 0 THEN 'soon' ELSE CAST(event_id % 900 AS VARCHAR) END AS BIGINT), 300)) AS wait_s FROM events")
def backoff_wait(spark, sf_dir):
    header = F.when(F.col("event_id") % 3 == 0, "soon").otherwise((F.col("event_id") % 900).cast("string"))
    return table(spark, sf_dir, "events").select("event_id", pacing.backoff_wait(header, F.col("ts")).alias("wait_s"))


@PLANS.query("SELECT event_id, CAST(CASE WHEN user_id % 2 = 0 THEN pow(2, event_id % 3 + 1) ELSE 10 * (event_id % 3 + 1) END AS BIGINT) AS wait_s FROM events")
def retry_wait(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", pacing.retry_wait(F.col("event_id") % 3, F.col("user_id") % 2 == 0).alias("wait_s"))


@PLANS.query("""SELECT event_id, CASE WHEN s IN (401, 403, 429) OR (s >= 500 AND (a OR t >= 2)) THEN 'stop' WHEN s IN (500, 502, 503, 504) THEN 'retry' WHEN s = 200 THEN 'ok' ELSE 'raise' END AS outcome
    FROM (SELECT event_id, CASE event_id % 8 WHEN 0 THEN 401 WHEN 1 THEN 403 WHEN 2 THEN 429 WHEN 3 THEN 500 WHEN 4 THEN 503 WHEN 5 THEN 404 WHEN 6 THEN 501 ELSE 200 END AS s, user_id % 3 = 0 AS a, event_id % 3 AS t FROM events)""")
def status_class(spark, sf_dir):
    status = F.get(F.array(*[F.lit(x) for x in (401, 403, 429, 500, 503, 404, 501, 200)]), (F.col("event_id") % 8).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", pacing.status_class(status, F.col("user_id") % 3 == 0, F.col("event_id") % 3).alias("outcome"))


@PLANS.query("SELECT event_type, count(*) AS attempts, CAST(sum(event_id) AS BIGINT) AS bytes, count(*) FILTER (WHERE value < 30) AS failed FROM events GROUP BY event_type")
def attempt_report(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("attempts"), F.sum("event_id").alias("bytes"), F.count_if(F.col("value") < 30).alias("failed"))


@PLANS.query("""SELECT user_id, event_id, coalesce(sum(CASE WHEN place % 5 = 0 THEN 15.25 ELSE 1.5 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS start
    FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events)""")
def pacing_schedule(spark, sf_dir):
    """Start times of each user's attempts at a minimum distance with a rest behind every burst."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.lit(0.25).alias("took"))
    return pacing.schedule(rows, "user_id", "event_id", "took", delay=1.5, burst_size=5, burst_pause=15.0)
