"""Reviewed omissions and their references, feeds' holds, nested records, destinations, and reports of writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkspar.functions.text import collapse_space
from inkspar.operators import coverage, destinations, nested, omissions, reports, shared
from inkspar.plans.base import Plans
from inkspar.plans.sources import entry_pages
from inkspar.plans.tables import table
from inkspar.streaming import holds

PLANS = Plans()


@PLANS.query("""SELECT doc_id, CASE doc_id % 9 WHEN 1 THEN 'no mark of an incomplete source' WHEN 2 THEN 'not reviewed' WHEN 3 THEN 'another response_sha256' WHEN 4 THEN 'another source_url' WHEN 5 THEN 'another label' WHEN 6 THEN 'another id' WHEN 7 THEN 'the section is still there' END AS problem FROM documents""")
def validate_omissions(spark, sf_dir):
    """Records that leave out two sections each, every eighth none: with reviews of their own, of other responses, addresses, labels or ids, with none, and with the section still in them."""
    n, name = F.col("doc_id") % 9, F.col("doc_id").cast("string")
    sha, url, label = F.sha2(F.coalesce("text", F.lit("")), 256), F.concat(F.lit("u"), name), F.concat(F.lit("l"), name)
    other = lambda k, mine, theirs: F.when(n == k, theirs).otherwise(mine)
    review = lambda section: F.struct(
        other(3, sha, F.lit("x")).alias("response_sha256"), other(4, url, F.lit("x")).alias("source_url"), other(5, label, F.lit("x")).alias("label"), other(6, F.col("doc_id"), F.lit(-1).cast("bigint")).alias("id"), F.lit(section).alias("section"),
    )
    pair = F.array(review("Notes"), review("Tutorial"))
    rows = table(spark, sf_dir, "documents").withColumn("pair", pair)
    reviews = rows.filter(n != 2).select(F.explode("pair").alias("r")).select("r.*")
    changed = rows.select(F.explode("pair").alias("r")).select("r.response_sha256", "r.source_url", "r.label", "r.id", F.concat("r.section", F.lit("?")).alias("section"))
    records = rows.select(
        "doc_id", sha.alias("response_sha256"), url.alias("source_url"), label.alias("label"), F.col("doc_id").alias("id"), F.when(n == 8, F.slice("pair", 1, 0)).otherwise(F.col("pair")).alias("omissions"),
        F.when(n == 7, F.array(F.lit("Tutorial"))).otherwise(F.array(F.lit("header"))).alias("section_kinds"), F.when(n == 1, F.lit(None)).otherwise(n == 8).alias("source_sections_complete"),
    )
    return omissions.validated(records, reviews.unionByName(changed), "doc_id")


_CLEAN = "trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))"


@PLANS.query(f"""WITH c AS (SELECT doc_id, length({_CLEAN}) AS n FROM documents) SELECT doc_id, CAST(place AS INTEGER) AS place, CASE WHEN doc_id % 7 = 3 THEN 'no body' WHEN n < 4 OR (doc_id % 7 = 2 AND place = 1) THEN 'outside' WHEN doc_id % 7 = 1 AND place = 0 THEN 'differs' ELSE 'equal' END AS outcome
    FROM c, (VALUES (0), (1), (2)) p(place)""")
def credit_references(spark, sf_dir):
    """Three passages of every document looked up in a reference body by its hash, piece by piece of 500 code points: whole bodies, and parts that cross pieces; some with another hash, past the body's end, or in a body that isn't there."""
    clean = F.trim(collapse_space(F.coalesce("text", F.lit(""))))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", clean.alias("t")).withColumn("sha", F.sha2(F.col("t"), 256)).withColumn("n", F.length("t"))
    kind = F.col("doc_id") % 7
    passage = lambda at, size, wrong: F.struct(at.cast("long").alias("offset"), size.cast("long").alias("length"), F.when(wrong, "x").otherwise(F.sha2(F.substr(F.col("t"), (at + 1).cast("int"), size.cast("int")), 256)).alias("sha256"))
    small = F.col("n") < 4
    third = F.floor(F.col("n") / 3)
    three = F.array(
        passage(F.lit(0), F.when(small, 0).otherwise(F.col("n")), kind == 1), passage(F.when((kind == 2) | small, F.col("n") - third + 1).otherwise(third), F.greatest(third, F.lit(1)), F.lit(False)), passage(F.when(small, 0).otherwise(1), F.when(small, 0).otherwise(F.col("n") - 2), F.lit(False)),
    )
    passages = docs.select("doc_id", F.when(kind == 3, "gone").otherwise(F.col("sha")).alias("reference_sha256"), F.posexplode(three).alias("place", "p")).select("doc_id", "place", "reference_sha256", "p.*")
    parts = shared.cut(omissions.pieces(docs, "sha", "text", 500))
    return omissions.referenced(passages, parts, "doc_id", 500)


_ATTEMPTS = "SELECT event_id // 2 AS attempt, '/f' || (event_id // 2) % 150 AS feed_path, event_id % 2 = 1 AS closed FROM events WHERE NOT (event_id % 2 = 1 AND (event_id // 2) % 5 = 0)"
_HELD = f"""WITH a AS ({_ATTEMPTS}), m AS (SELECT feed_path, max(attempt) AS attempt FROM a GROUP BY 1), s AS (SELECT feed_path, attempt, bool_or(closed) AS closed FROM a JOIN m USING (feed_path, attempt) GROUP BY ALL)
    SELECT feed_path, attempt, CASE WHEN NOT closed THEN 'pending' WHEN attempt % 7 = 0 THEN 'failed' WHEN attempt % 11 = 0 THEN 'review_required' ELSE 'parsed' END AS status, CASE WHEN closed THEN sha256(CAST(attempt AS VARCHAR)) END AS record_sha256, closed AND attempt % 7 <> 0 AND attempt % 11 <> 0 AS exportable FROM s"""


def _attempts(spark, sf_dir):
    n = F.floor(F.col("event_id") / 2)
    closed = F.col("event_id") % 2 == 1
    status = F.when(n % 7 == 0, "failed").when(n % 11 == 0, "review_required").otherwise("parsed")
    rows = table(spark, sf_dir, "events").filter(~(closed & (n % 5 == 0)))
    return rows.select(F.concat(F.lit("/f"), (n % 150).cast("string")).alias("feed_path"), n.alias("attempt"), F.when(closed, "result").otherwise("begin").alias("phase"), F.when(closed, status).alias("status"), F.when(closed, F.sha2(n.cast("string"), 256)).alias("record_sha256"))


@PLANS.query(_HELD)
def feed_holds(spark, sf_dir):
    """The states of feeds after all attempts to read them: an attempt without a result holds a feed, whatever older ones gave."""
    return holds.states(_attempts(spark, sf_dir))


@PLANS.query(_HELD)
def feed_holds_stream(spark, sf_dir):
    """The same from a stream of attempts with a row of state for each feed; the last change of each feed."""
    source, out, place = (shared.fresh(spark, name) for name in ("attempts", "changes", "progress"))
    _attempts(spark, sf_dir).repartition(6).write.parquet(source)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        rows = spark.readStream.schema(holds.ATTEMPTS).option("maxFilesPerTrigger", 3).parquet(source)
        write = lambda batch, number: batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(out)
        holds.stream(rows).writeStream.outputMode("update").option("checkpointLocation", place).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    finally:
        spark.conf.set(key, before)
    changes = spark.read.schema(f"{holds.STATES}, batch long").parquet(out)
    return changes.groupBy("feed_path").agg(F.max_by(F.struct("attempt", "status", "record_sha256", "exportable"), "batch").alias("s")).select("feed_path", "s.*")


@PLANS.query("""SELECT conv_id, CAST(turn AS INTEGER) AS position, role, CAST(conv_id AS VARCHAR) AS latest_indexed_timestamp, 'https://example.org/' || conv_id AS license_url, CASE WHEN turn > 0 AND conv_id % 3 = 0 AND turn = (SELECT max(turn) FROM conversations d WHERE d.conv_id = c.conv_id) THEN 'role_of_page' END AS foreign_field FROM conversations c""")
def annotate_archive_record(spark, sf_dir):
    """Conversations as pages of nested entries: fields set on a page and on all of its entries, one of them two levels down; the last entry of some pages says that it is of another page."""
    licence = F.struct(F.lit("old").alias("url"))
    entry = F.struct("turn", "role", F.lit("old").alias("latest_indexed_timestamp"), licence.alias("license"), F.lit("p").alias("role_of_page"))
    pages = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(entry)).alias("all"))
    last = F.size("all") - 1
    kin = F.transform(F.expr("slice(all, 2, size(all))"), lambda e, i: e.withField("role_of_page", F.when((F.col("conv_id") % 3 == 0) & (i == last - 1), "q").otherwise("p")))
    folded = pages.select("conv_id", F.get("all", F.lit(0)).alias("own"), kin.alias("additional_entries")).select("conv_id", "own.*", "additional_entries")
    number = F.col("conv_id").cast("string")
    made = nested.annotated(folded, "additional_entries", latest_indexed_timestamp=number)
    for path in ("license.url", "additional_entries.license.url"):
        made = nested.with_path(made, path, F.concat(F.lit("https://example.org/"), number))
    found = nested.foreign_fields(made, "additional_entries", ("latest_indexed_timestamp", "license", "role_of_page"))
    wrong = F.when(F.size("foreign") > 0, F.array_join("foreign", ","))
    parent = found.select("conv_id", F.struct("turn", "role", "latest_indexed_timestamp", "license", "role_of_page").alias("e"), F.lit(None).cast("string").alias("wrong"))
    child = found.select("conv_id", F.explode("additional_entries").alias("e"), wrong.alias("wrong"))
    every = parent.unionByName(child)
    return every.select("conv_id", F.col("e.turn").cast("int").alias("position"), "e.role", "e.latest_indexed_timestamp", F.col("e.license.url").alias("license_url"), F.when(F.col("e.role_of_page") == "q", F.col("wrong")).alias("foreign_field"))


@PLANS.query("""SELECT user_id, CAST(n AS INTEGER) AS position, CAST(user_id + n AS BIGINT) AS id FROM (SELECT DISTINCT user_id FROM events), generate_series(0, 2) t(n)""")
def expand_archive_records(spark, sf_dir):
    """Pages of three entries each, flattened; all entries of a page have its provenance."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    sha = F.sha2(F.col("user_id").cast("string"), 256)
    kin = F.array(*[F.struct((F.col("user_id") + n).alias("id"), sha.alias("response_sha256")) for n in (1, 2)])
    pages = users.select("user_id", F.col("user_id").alias("id"), sha.alias("response_sha256"), kin.alias("additional_entries"))
    return nested.expanded(pages, "additional_entries", "user_id").select("user_id", "position", "record.id")


_PATHS = "SELECT event_id, CASE event_id % 6 WHEN 0 THEN '/d/' || user_id WHEN 1 THEN '/d/' || user_id || '/x/' || event_id WHEN 2 THEN '/d/' || user_id || '0' || event_id WHEN 3 THEN '/e/' || event_id || '/../x' WHEN 4 THEN '//d/./' || user_id || '/' ELSE 'd/' || user_id END AS path FROM events"


@PLANS.query(f"""WITH p AS (SELECT event_id, CASE WHEN event_id % 6 <> 3 THEN regexp_replace(replace(regexp_replace(path, '/+', '/', 'g'), '/./', '/'), '/$', '') END AS path FROM ({_PATHS})), f AS (SELECT path, min(event_id) AS other FROM p WHERE path IS NOT NULL GROUP BY path)
    SELECT p.event_id, other, 'inside' AS kind FROM p JOIN f ON starts_with(p.path, f.path || '/') UNION ALL SELECT other, p.event_id, 'equal' FROM p JOIN f USING (path) WHERE p.event_id <> other""")
def preflight_export(spark, sf_dir):
    """Destinations that are equal or inside one another: folders, files below them, siblings whose names begin alike, absolute and relative paths, and paths that climb."""
    n, user = F.col("event_id"), F.col("user_id").cast("string")
    kind = n % 6
    number = n.cast("string")
    path = (
        F.when(kind == 0, F.concat(F.lit("/d/"), user)).when(kind == 1, F.concat(F.lit("/d/"), user, F.lit("/x/"), number)).when(kind == 2, F.concat(F.lit("/d/"), user, F.lit("0"), number))
        .when(kind == 3, F.concat(F.lit("/e/"), number, F.lit("/../x"))).when(kind == 4, F.concat(F.lit("//d/./"), user, F.lit("/"))).otherwise(F.concat(F.lit("d/"), user))
    )
    return destinations.overlaps(table(spark, sf_dir, "events").select("event_id", path.alias("path")), "event_id", "path")


@PLANS.query("""SELECT (SELECT {'parsed': count(*) FILTER (WHERE k = 0), 'excluded': count(*) FILTER (WHERE k = 1), 'review_required': count(*) FILTER (WHERE k = 2), 'failed': count(*) FILTER (WHERE k = 3), 'pending': count(*) FILTER (WHERE k = 4), 'rows': count(*), 'unknown': count(*) FILTER (WHERE k = 5), 'complete': bool_and(k < 2)} FROM (SELECT doc_id % 6 AS k FROM documents)) AS crawl,
    (SELECT {'indexed': count(*) FILTER (WHERE i), 'captured': count(*) FILTER (WHERE c), 'pending': count(*) FILTER (WHERE i AND NOT c), 'unexpected': count(*) FILTER (WHERE c AND NOT i), 'covered': bool_and(c OR NOT i)} FROM (SELECT doc_id % 4 > 0 AS i, doc_id % 5 > 0 AS c FROM documents)) AS coverage,
    (SELECT {'requests': count(*), 'bytes': CAST(sum(octet_length(encode(html))) AS BIGINT), 'failures': count(*) FILTER (WHERE page_id % 10 = 0), 'first_at': min(url), 'last_at': max(url)} FROM pages) AS requests""")
def sink_report_json(spark, sf_dir):
    """Crawl, coverage and request reports of two tables, gathered while they are written."""
    out = shared.fresh(spark, "reported")
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    n = F.col("doc_id")
    status = F.get(F.array(*map(F.lit, [*reports.STATUSES, "other"])), (n % 6).cast("int"))
    crawl = reports.crawl_metrics(status)
    covered = reports.coverage_metrics(n % 4 > 0, n % 5 > 0)
    seen = reports.observed_write(docs, lambda df: df.write.parquet(f"{out}/documents"), **crawl, **{f"coverage_{k}": v for k, v in covered.items()})
    requests = reports.observed_write(pages, lambda df: df.write.parquet(f"{out}/pages"), **reports.request_metrics(F.col("url"), F.octet_length("html"), F.col("page_id") % 10 == 0))
    return reports.one_row(docs, crawl={k: seen[k] for k in crawl}, coverage={k: seen[f"coverage_{k}"] for k in covered}, requests=requests)


@PLANS.query("""WITH p AS (SELECT * FROM part) SELECT p_partkey, 'stray' AS run, CAST(1 AS BIGINT) AS extra FROM p WHERE p_partkey % 5 = 0 UNION ALL SELECT p_partkey, 'lost', -1 FROM p WHERE p_partkey % 3 = 0 UNION ALL SELECT p_partkey, p_name, 1 FROM p WHERE p_partkey % 3 = 0""")
def unmapped_text(spark, sf_dir):
    """Runs of text of entry pages against those that their records hold, as bags: some pages show a further run, and some records hold another text in place of one of three equal runs."""
    key = F.col("p_partkey")
    shown = entry_pages(spark, sf_dir).select("p_partkey", coverage.runs(F.concat("html", F.when(key % 5 == 0, "<p> stray </p>").otherwise("<script>stray</script>"))).alias("runs"))
    foot = F.concat(F.lit("#1 "), "p_brand")
    level = F.concat(F.lit("JLPT N"), (F.col("p_size") % 7).cast("string"))
    name = F.when(key % 3 == 0, "lost").otherwise(F.col("p_name"))
    texts = F.array("p_name", "p_brand", level, "p_type", "p_brand", foot, "p_name", "p_type", "p_brand", "p_type", foot, "p_type", name, "p_brand")
    return coverage.unmapped(shown, table(spark, sf_dir, "part").select("p_partkey", texts.alias("runs")), "p_partkey", ("see",))
