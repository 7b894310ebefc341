"""Joins, gates, sets, aggregates and differences over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkspar.functions.text import digest
from inkspar.operators import fingerprint, normalize, relational
from inkspar.functions.text import collapse_space
from inkspar.operators.omissions import passages_hold
from inkspar.operators.passages import containing
from inkspar.plans.base import Plans
from inkspar.sources import records
from inkspar.plans.tables import table

PLANS = Plans()


@PLANS.query("SELECT l_orderkey, l_linenumber, o_orderpriority, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_suppkey % 7 = o_custkey % 7")
def join_example_translation(spark, sf_dir):
    """An inner join on two keys."""
    left = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k1"), (F.col("l_suppkey") % 7).alias("k2"), "l_linenumber", "l_quantity")
    right = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k1"), (F.col("o_custkey") % 7).alias("k2"), "o_orderpriority")
    return left.join(right, ["k1", "k2"]).select(F.col("k1").alias("l_orderkey"), "l_linenumber", "o_orderpriority", "l_quantity")


@PLANS.query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'F')")
def join_dangling_targets(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return normalize.orphans(lines, ["l_orderkey"], table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'"), ["o_orderkey"])


_STATES = "SELECT doc_id, CASE quality WHEN 1 THEN 'parsed' ELSE 'review_required' END AS status, CASE WHEN doc_id % 5 = 0 THEN 'x' ELSE sha256(text) END AS record_sha256 FROM labels JOIN documents USING (doc_id)"


@PLANS.query(f"""SELECT d.doc_id, CASE WHEN s.doc_id IS NULL THEN 'no state' WHEN s.status <> 'parsed' THEN s.status WHEN s.record_sha256 <> sha256(d.text) THEN 'record_sha256 differs' ELSE 'exportable' END AS outcome FROM documents d LEFT JOIN ({_STATES}) s ON d.doc_id = s.doc_id""")
def join_record_state(spark, sf_dir):
    records = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("record_sha256"))
    states = table(spark, sf_dir, "labels").join(records, "doc_id").select("doc_id", F.when(F.col("quality") == 1, "parsed").otherwise("review_required").alias("status"), F.when(F.col("doc_id") % 5 == 0, "x").otherwise(F.col("record_sha256")).alias("record_sha256"))
    return relational.joined_state(records, states, "doc_id", ["record_sha256"]).select("doc_id", "outcome")


@PLANS.query("SELECT e.event_id FROM events e WHERE EXISTS (SELECT 1 FROM events c WHERE c.event_id % 2 = 0 AND c.user_id = e.user_id AND c.ts = e.ts AND c.event_type = e.event_type AND c.value = e.value AND c.props = e.props)")
def join_inventory_capture(spark, sf_dir):
    """A semi join on five columns."""
    rows = table(spark, sf_dir, "events")
    keys = ["user_id", "ts", "event_type", "value", "props"]
    return rows.join(rows.filter("event_id % 2 = 0").select(*keys).distinct(), keys, "left_semi").select("event_id")


@PLANS.query("SELECT c_custkey, n_name, CASE WHEN n_regionkey IN (0, 1) THEN 'include' WHEN n_regionkey = 2 THEN 'exclude' END AS decision FROM customer JOIN nation ON c_nationkey = n_nationkey")
def join_review_manifest(spark, sf_dir):
    """Decisions of a small table that a person keeps, joined to every record; Spark broadcasts it while it is small."""
    decision = F.when(F.col("n_regionkey").isin(0, 1), "include").when(F.col("n_regionkey") == 2, "exclude")
    manifest = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", decision.alias("decision"))
    return table(spark, sf_dir, "customer").join(manifest, "c_nationkey").select("c_custkey", "n_name", "decision")


@PLANS.query("""SELECT label, CAST(coalesce(max(c), min(a)) AS BIGINT) AS id FROM (SELECT p_brand AS label, p_partkey AS c, NULL AS a FROM part WHERE p_size < 25 UNION ALL SELECT p_brand, NULL, p_partkey FROM part WHERE p_size >= 20 UNION ALL SELECT p_type, NULL, p_partkey FROM part) GROUP BY label""")
def join_labels_union_first_wins(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    current = part.filter("p_size < 25").select(F.col("p_brand").alias("label"), F.col("p_partkey").alias("id"))
    archive = part.filter("p_size >= 20").select(F.col("p_brand").alias("label"), F.col("p_partkey").alias("id")).unionByName(part.select(F.col("p_type").alias("label"), F.col("p_partkey").alias("id")))
    return relational.first_wins([current, archive], "label", F.col("id"), first_part_last_wins=True)


@PLANS.query("""SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.turn, b.turn) AS turn, a.r AS left_value, b.r AS right_value, CASE WHEN b.conv_id IS NULL THEN 'left only' WHEN a.conv_id IS NULL THEN 'right only' ELSE 'both' END AS side
    FROM (SELECT conv_id, turn, role AS r FROM conversations WHERE turn < 3) a FULL JOIN (SELECT conv_id - 1 AS conv_id, turn, role AS r FROM conversations) b ON a.conv_id = b.conv_id AND a.turn = b.turn""")
def zip_positional(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return relational.zipped(turns.filter("turn < 3"), turns.withColumn("conv_id", F.col("conv_id") - 1), ["conv_id", "turn"], "role")


@PLANS.query("SELECT 'documents without labels' AS side, count(*) AS n_ids FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) UNION ALL SELECT 'labels without documents', count(*) FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE l.doc_id = d.doc_id AND d.lang <> 'en')")
def set_membership(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return normalize.violations([("documents without labels", relational.missing(docs, labels, "doc_id")), ("labels without documents", relational.missing(labels, docs.filter("lang <> 'en'"), "doc_id"))]).select(F.col("check_name").alias("side"), F.col("n_rows").alias("n_ids"))


@PLANS.query("SELECT DISTINCT user_id FROM events WHERE event_type = 'click' EXCEPT SELECT user_id FROM events WHERE event_type <> 'click' AND value < 1")
def set_difference(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return rows.filter("event_type = 'click'").select("user_id").subtract(rows.filter("event_type <> 'click' AND value < 1").select("user_id"))


@PLANS.query("SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def filter_selector(spark, sf_dir):
    return relational.selected(table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels").filter("toxic = 1"))


@PLANS.query("""SELECT doc_id, CASE WHEN source IN ('src1', 'src2') THEN 'parsed' WHEN toxic = 0 THEN 'parsed' WHEN quality = 1 THEN 'parsed' WHEN quality = 0 OR source IS NOT NULL THEN 'excluded' ELSE 'review_required' END AS status,
    CASE WHEN source IN ('src1', 'src2') THEN 'category' WHEN toxic = 0 THEN 'verified current id' WHEN quality = 1 THEN 'reviewed' WHEN quality = 0 OR source IS NOT NULL THEN 'outside the collection' ELSE 'no category' END AS reason
    FROM (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE source END AS source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))""")
def membership_scope(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 9 != 0, F.col("source")).alias("source")).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    decision = F.when(F.col("quality") == 1, "include").when(F.col("quality") == 0, "exclude")
    return rows.select("doc_id", relational.membership(F.col("source"), F.col("toxic") == 0, decision, ("src1", "src2")).alias("m")).select("doc_id", "m.status", "m.reason")


@PLANS.query("SELECT event_type, count(*) AS n_rows FROM events WHERE value > 10 AND event_type <> 'view' AND user_id IS NOT NULL GROUP BY event_type")
def filter_mime_status(spark, sf_dir):
    return table(spark, sf_dir, "events").filter("value > 10 AND event_type <> 'view' AND user_id IS NOT NULL").groupBy("event_type").agg(F.count("*").alias("n_rows"))


@PLANS.query("""SELECT source, arg_max(status, part) AS status FROM (SELECT source, 'a' || min(lang) AS status, 1 AS part FROM documents GROUP BY source UNION ALL SELECT CASE WHEN source = 'src3' THEN 'other' ELSE source END, 'b' || max(lang), 2 FROM documents GROUP BY 1) GROUP BY source""")
def legacy_holds(spark, sf_dir):
    """Of several reports the later one's status counts; one source is in the first report only, and one in the second."""
    docs = table(spark, sf_dir, "documents")
    one = docs.groupBy("source").agg(F.concat(F.lit("a"), F.min("lang")).alias("status")).withColumn("part", F.lit(1))
    two = docs.groupBy(F.when(F.col("source") == "src3", "other").otherwise(F.col("source")).alias("source")).agg(F.concat(F.lit("b"), F.max("lang")).alias("status")).withColumn("part", F.lit(2))
    return one.unionByName(two).groupBy("source").agg(F.max_by("status", "part").alias("status"))


@PLANS.query("SELECT page_id, sha256(html) AS body_sha256, url = 'https://www.example.org/' || CAST(page_id AS VARCHAR) AS url_agrees FROM pages WHERE length(html) > 0")
def source_cache(spark, sf_dir):
    """Bodies stored by hash, joined back to their addresses and checked again."""
    pages = table(spark, sf_dir, "pages")
    index = pages.select("page_id", "url", F.sha2("html", 256).alias("sha256"))
    bodies = pages.select(F.sha2("html", 256).alias("sha256"), "html").dropDuplicates(["sha256"])
    joined = index.join(bodies, "sha256").filter(F.sha2("html", 256) == F.col("sha256"))
    return joined.select("page_id", F.col("sha256").alias("body_sha256"), (F.col("url") == F.concat(F.lit("https://www.example.org/"), F.col("page_id").cast("string"))).alias("url_agrees"))


@PLANS.query("SELECT kind, count(*) AS n_rows FROM (SELECT role AS kind FROM conversations UNION ALL SELECT lang FROM documents) GROUP BY kind")
def count_by_kind(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(F.col("role").alias("kind")).unionByName(table(spark, sf_dir, "documents").select(F.col("lang").alias("kind"))).groupBy("kind").agg(F.count("*").alias("n_rows"))


@PLANS.query("SELECT coalesce(CASE WHEN lang <> 'en' THEN lang END, 'unknown') AS category, count(*) AS n_rows FROM documents GROUP BY 1")
def count_by_category(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.coalesce(F.when(F.col("lang") != "en", F.col("lang")), F.lit("unknown")).alias("category")).agg(F.count("*").alias("n_rows"))


@PLANS.query("SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT user_id) FILTER (WHERE value > 50) AS eligible FROM events GROUP BY event_type")
def distinct_count(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.countDistinct("user_id").alias("users"), F.countDistinct(F.when(F.col("value") > 50, F.col("user_id"))).alias("eligible"))


@PLANS.query("SELECT count(DISTINCT l_suppkey) AS eligible_ids_count, sha256('[' || string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ',' ORDER BY l_suppkey) || ']') AS eligible_ids_sha256 FROM lineitem".replace("string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ',' ORDER BY l_suppkey)", "(SELECT string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) FROM (SELECT DISTINCT l_suppkey AS k FROM lineitem))"))
def membership_metadata(spark, sf_dir):
    """The count and digest of the sorted different ids of a reviewed membership."""
    ids = table(spark, sf_dir, "lineitem").select("l_suppkey").distinct()
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("l_suppkey")), lambda x: x.cast("string")), ",")
    return ids.agg(F.count("*").alias("eligible_ids_count"), F.sha2(F.concat(F.lit("["), listed, F.lit("]")), 256).alias("eligible_ids_sha256"))


_HASHED = """SELECT sha256({}) AS h FROM {}"""
_CODED = {"nation": ["n_name", "n_nationkey", "n_regionkey"], "region": ["r_name", "r_regionkey"], "labels": ["doc_id", "quality", "toxic"]}


def _fingerprint_sql(name: str) -> str:
    coded = " || ".join(f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in _CODED[name])
    return f"SELECT '{name}' AS relation, CAST(sum(n) AS BIGINT) AS row_count, sha256(string_agg(d, '' ORDER BY b)) AS sha256 FROM (SELECT substr(h, 1, 3) AS b, sha256(string_agg(h, '' ORDER BY h)) AS d, count(*) AS n FROM ({_HASHED.format(coded, name)}) GROUP BY 1)"


@PLANS.query(" UNION ALL ".join(_fingerprint_sql(n) for n in _CODED))
def relation_fingerprint(spark, sf_dir):
    a, b, c = (fingerprint.combined(fingerprint.plain_row_hashes(table(spark, sf_dir, n)), n) for n in _CODED)
    return a.unionByName(b).unionByName(c)


_CANONICAL = {"nation": ["n_name", "n_nationkey", "n_regionkey"], "labels": ["doc_id", "quality", "toxic"], "conversations": ["conv_id", "role", "text", "turn"]}


def _canonical_sql(name: str) -> str:
    form = "to_json({" + ", ".join(f"'{c}': {c}" for c in _CANONICAL[name]) + "})"
    return f"SELECT '{name}' AS relation, CAST(sum(n) AS BIGINT) AS row_count, sha256(string_agg(d, '' ORDER BY b)) AS sha256 FROM (SELECT substr(h, 1, 3) AS b, sha256(string_agg(h, '' ORDER BY h)) AS d, count(*) AS n FROM (SELECT sha256(CAST({form} AS VARCHAR)) AS h FROM {name}) GROUP BY 1)"


@PLANS.query(" UNION ALL ".join(_canonical_sql(n) for n in _CANONICAL))
def relation_fingerprint_canonical(spark, sf_dir):
    """Fingerprints over canonical JSON rows."""
    a, b, c = (fingerprint.fingerprint(table(spark, sf_dir, n), n) for n in _CANONICAL)
    return a.unionByName(b).unionByName(c)


@PLANS.query("SELECT 'nation' AS relation, 'rows differ' AS outcome UNION ALL SELECT 'region', 'equal' UNION ALL SELECT 'labels', 'content differs'")
def fingerprint_compare(spark, sf_dir):
    now = {n: table(spark, sf_dir, n) for n in _CODED}
    before = now | {"nation": now["nation"].filter("n_nationkey > 0"), "labels": now["labels"].withColumn("toxic", 1 - F.col("toxic"))}
    both = []
    for tables in (before, now):
        a, b, c = (fingerprint.combined(fingerprint.plain_row_hashes(df), n) for n, df in tables.items())
        both.append(a.unionByName(b).unionByName(c))
    return fingerprint.compared(*both)


@PLANS.query(f"SELECT 'nation' AS relation, '{digest([['n_name', 'string'], ['n_nationkey', 'int'], ['n_regionkey', 'int']])}' AS sha256")
def sql_catalog_scan(spark, sf_dir):
    """The schema fingerprint."""
    return fingerprint.schema_fingerprint(table(spark, sf_dir, "nation"), "nation")


@PLANS.query("SELECT count(*) FILTER (WHERE quality = 1) = count(*) AS complete, bool_and(toxic = 0) AS coverage_verified, bool_or(quality = 1) AS export_ready FROM labels")
def bool_rollup(spark, sf_dir):
    return table(spark, sf_dir, "labels").agg(F.bool_and(F.col("quality") == 1).alias("complete"), F.bool_and(F.col("toxic") == 0).alias("coverage_verified"), F.bool_or(F.col("quality") == 1).alias("export_ready"))


@PLANS.query("SELECT 'nation' AS relation, count(*) AS n_rows, count(*) = 25 AS as_expected FROM nation UNION ALL SELECT 'region', count(*), count(*) = 5 FROM region UNION ALL SELECT 'documents', count(*), count(*) = 7 FROM documents")
def sql_count_tables(spark, sf_dir):
    expected = {"nation": 25, "region": 5, "documents": 7}
    found = normalize.violations([(n, table(spark, sf_dir, n)) for n in expected])
    wanted = spark.createDataFrame(list(expected.items()), "check_name string, wanted bigint")
    return found.join(wanted, "check_name").select(F.col("check_name").alias("relation"), "n_rows", (F.col("n_rows") == F.col("wanted")).alias("as_expected"))


@PLANS.query("SELECT count(*) AS licences, count(*) = 1 AS single FROM (SELECT DISTINCT lang, source LIKE 'src%' AS s FROM documents)")
def sql_distinct_license(spark, sf_dir):
    kinds = table(spark, sf_dir, "documents").select("lang", F.col("source").like("src%").alias("s")).distinct()
    return kinds.agg(F.count("*").alias("licences"), (F.count("*") == 1).alias("single"))


_FK = [("lineitem without order", "lineitem", "l_orderkey", "orders", "o_orderkey"), ("orders without customer", "orders", "o_custkey", "customer", "c_custkey"), ("customer without nation", "customer", "c_nationkey", "nation", "n_nationkey"), ("nation without region", "nation", "n_regionkey", "region", "r_regionkey"), ("labels without document", "labels", "doc_id", "documents", "doc_id")]
_PK = [("orders repeated", "orders", "o_orderkey"), ("part repeated", "part", "p_partkey"), ("documents repeated", "documents", "doc_id"), ("pages repeated", "pages", "page_id"), ("lines repeated", "lineitem", "l_orderkey, l_linenumber")]


@PLANS.query(" UNION ALL ".join([f"SELECT '{n}' AS check_name, count(*) AS n_rows FROM {c} c WHERE {k} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} p WHERE p.{pk} = c.{k})" for n, c, k, p, pk in _FK] + [f"SELECT '{n}', count(*) FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1)" for n, t, k in _PK]))
def sql_integrity(spark, sf_dir):
    """Primary and foreign keys of all tables."""
    t = lambda n: table(spark, sf_dir, n)
    return normalize.violations([(n, normalize.orphans(t(c), [k], t(p), [pk])) for n, c, k, p, pk in _FK] + [(n, normalize.repeated_keys(t(name), *k.split(", "))) for n, name, k in _PK])


@PLANS.query("SELECT count(*) FILTER (WHERE p_size NOT BETWEEN 1 AND 50) AS bad_size, count(*) FILTER (WHERE p_retailprice <= 0) AS bad_price, count(*) FILTER (WHERE p_name IS NULL) AS bad_name FROM part")
def level_check(spark, sf_dir):
    return table(spark, sf_dir, "part").agg(F.count_if(~F.col("p_size").between(1, 50)).alias("bad_size"), F.count_if(F.col("p_retailprice") <= 0).alias("bad_price"), F.count_if(F.col("p_name").isNull()).alias("bad_name"))


@PLANS.query("SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents")
def record_roundtrip(spark, sf_dir):
    """All documents as records, written as YAML and read again."""
    docs = table(spark, sf_dir, "documents")
    made = docs.select(F.to_json(F.struct("doc_id", "text", "lang", "source", "n_chars"), {"ignoreNullFields": "false"}).alias("j"))
    back = made.select(records.loaded(records.dumped(F.col("j"))).alias("r")).select(F.from_json("r.record_json", docs.schema).alias("d")).select("d.*")
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


_PAGES = "SELECT (CASE {} % 3 WHEN 0 THEN 'n1/' WHEN 1 THEN 'n2/' ELSE 'unclassified/' END) || doc_id || '.md' AS path, sha256({}) AS sha256 FROM documents"


@PLANS.query(f"""SELECT coalesce(a.path, b.path) AS path, CASE WHEN a.path IS NULL THEN 'added' WHEN b.path IS NULL THEN 'removed' WHEN a.sha256 = b.sha256 THEN 'unchanged' ELSE 'updated' END AS change
    FROM ({_PAGES.format("doc_id", "text")}) a FULL JOIN ({_PAGES.format("CASE WHEN doc_id % 7 = 0 THEN doc_id + 1 ELSE doc_id END", "CASE WHEN doc_id % 4 = 0 THEN text || '!' ELSE text END")}) b ON a.path = b.path""")
def sink_markdown_incremental(spark, sf_dir):
    """Which pages an update writes, removes and leaves: every seventh moves to another level, every fourth has another text."""
    docs = table(spark, sf_dir, "documents")
    folder = lambda n: F.when(n % 3 == 0, "n1/").when(n % 3 == 1, "n2/").otherwise("unclassified/")
    path = lambda n: F.concat(folder(n), F.col("doc_id").cast("string"), F.lit(".md")).alias("path")
    old = docs.select(path(F.col("doc_id")), F.sha2("text", 256).alias("sha256"))
    moved = F.when(F.col("doc_id") % 7 == 0, F.col("doc_id") + 1).otherwise(F.col("doc_id"))
    new = docs.select(path(moved), F.sha2(F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256).alias("sha256"))
    return relational.differences(old, new, ["path"], "sha256")


@PLANS.query("""WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey AS s, l_suppkey * 2 % 97 AS t FROM lineitem), r(node) AS (SELECT CAST(1 AS BIGINT) UNION SELECT t FROM e JOIN r ON s = node) SELECT node FROM r""")
def transitive_closure(spark, sf_dir):
    edges = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("source"), (F.col("l_suppkey") * 2 % 97).alias("target")).distinct()
    return relational.closure(edges, spark.range(1, 2)).select("node")


@PLANS.query("SELECT conv_id, CAST(turn AS INTEGER) AS position, role, text FROM conversations")
def expand_components(spark, sf_dir):
    """Conversations folded to one page each with nested entries, and unfolded again."""
    entry = F.struct("turn", "role", "text")
    pages = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(entry)).alias("all"))
    folded = pages.select("conv_id", F.get("all", F.lit(0)).alias("own"), F.expr("slice(all, 2, size(all))").alias("additional_entries")).select("conv_id", "own.*", "additional_entries")
    flat = normalize.expand_components(folded, "additional_entries", "conv_id", [])
    return flat.select(F.col("page_key").alias("conv_id"), F.col("turn").cast("int").alias("position"), "role", "text")


@PLANS.query(r"""SELECT doc_id, CAST(i - 1 AS INTEGER) AS position, w AS form FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS w, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)""")
def posexplode_relation(spark, sf_dir):
    """A child relation with its positions: one row for each line."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("forms"))
    return normalize.child_relation(rows, "doc_id", "doc_id", "forms", {"form": F.col("item")})


@PLANS.query("""SELECT DISTINCT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(regexp_replace(d.text, '\\s+', ' ', 'g'), regexp_replace(b.text, '\\s+', ' ', 'g'))""")
def containing_passages(spark, sf_dir):
    """Documents that hold a passage, white space aside. Passages are few and looked for by the hash of their first words."""
    items = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("passage"))
    return containing(table(spark, sf_dir, "documents").select("doc_id", "text"), items)


@PLANS.query("""WITH c AS (SELECT doc_id, length(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))) // 5 AS k FROM documents)
    SELECT doc_id, CAST(k AS INTEGER) AS passage_chars, k >= 200 AND CASE doc_id % 5 WHEN 0 THEN 3 * k >= 1000 WHEN 1 THEN false WHEN 2 THEN false WHEN 3 THEN 2 * k >= 1000 ELSE false END AS holds FROM c""")
def reviewed_credit(spark, sf_dir):
    """A reviewed credit rests on ordered, separate passages of enough length with their hashes: right ones, a wrong hash, an overlap, fewer ones, and one past the end."""
    clean = F.trim(collapse_space(F.coalesce("text", F.lit(""))))
    rows = table(spark, sf_dir, "documents").select("doc_id", clean.alias("t")).withColumn("k", F.floor(F.length("t") / 5).cast("int"))
    t, k, kind = F.col("t"), F.col("k"), F.col("doc_id") % 5
    passage = lambda at, sha=None: F.struct(at.cast("int").alias("offset"), k.alias("length"), F.coalesce(sha, F.sha2(F.substr(t, at + 1, k), 256)).alias("sha256"))
    none = F.lit(None).cast("string")
    good = F.array(passage(F.lit(0), none), passage(k, none), passage(3 * k, none))
    wrong = F.array(passage(F.lit(0), none), passage(k, F.lit("x")), passage(3 * k, none))
    over = F.array(passage(F.lit(0), none), passage(F.greatest(k - 1, F.lit(0)), none), passage(3 * k, none))
    past = F.array(passage(F.lit(0), none), passage(k, none), passage(F.length(t) - k + 1, none))
    passages = F.when(kind == 0, good).when(kind == 1, wrong).when(kind == 2, over).when(kind == 3, F.slice(good, 1, 2)).otherwise(past)
    return rows.select("doc_id", k.alias("passage_chars"), passages_hold(t, passages).alias("holds"))
