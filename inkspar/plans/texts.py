"""Text, hash, licence, URL and JSON functions over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkspar.functions import licences, text, urls
from inkspar.plans.base import Plans
from inkspar.plans.tables import table

PLANS = Plans()


@PLANS.query("SELECT conv_id, turn, sha256(coalesce(role, 'None') || chr(0) || text) AS content_sha256 FROM conversations")
def comment_hash(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.comment_hash(F.col("role"), F.col("text")).alias("content_sha256"))


@PLANS.query("SELECT page_id, sha256(url) AS label_key FROM pages")
def label_key(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.key_of(F.col("url")).alias("label_key"))


@PLANS.query("SELECT event_id, concat_ws('-', 'current', CAST(event_id % 3 AS VARCHAR), CAST(user_id AS VARCHAR), substr(sha256(event_type), 1, 12)) AS observation_key FROM events")
def archive_record_key(spark, sf_dir):
    made = text.observation_key(F.lit(None).cast("string"), F.col("event_id") % 3, F.col("user_id"), F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", made.alias("observation_key"))


@PLANS.query("""SELECT p_partkey, CAST(nullif(regexp_extract('x JLPT N' || CAST(p_size AS VARCHAR) || ' y', 'JLPT N([1-5])', 1), '') AS INTEGER) AS jlpt_level FROM part""")
def level_extract(spark, sf_dir):
    noted = F.concat(F.lit("x JLPT N"), F.col("p_size").cast("string"), F.lit(" y"))
    return table(spark, sf_dir, "part").select("p_partkey", text.level_of(noted).alias("jlpt_level"))


_TITLES = "CASE WHEN s_suppkey % 3 = 0 THEN s_name || ' [' || CAST(s_nationkey AS VARCHAR) || '] (lab' || CAST(s_suppkey AS VARCHAR) || ')' WHEN s_suppkey % 3 = 1 THEN s_name || ' (lab)' ELSE s_name END"


@PLANS.query(rf"""SELECT s_suppkey, coalesce(nullif(regexp_extract(t, '{(shape := r"^\s*([^\[\(]+?)\s*(?:\[([^\]]*)\]\s*)?\(([^()]*)\)\s*$")}', 1), ''), t) AS title_name,
    nullif(regexp_extract(t, '{shape}', 2), '') AS reading, nullif(regexp_extract(t, '{shape}', 3), '') AS label FROM (SELECT s_suppkey, {_TITLES} AS t FROM supplier)""")
def title_split(spark, sf_dir):
    titled = table(spark, sf_dir, "supplier").select("s_suppkey", text.split_title(F.expr(_TITLES.replace("VARCHAR", "STRING"))).alias("t"))
    return titled.select("s_suppkey", F.col("t.name").alias("title_name"), "t.reading", "t.label")


@PLANS.query(r"SELECT doc_id, md5(regexp_replace(text, '\s+', ' ', 'g')) AS collapsed_md5 FROM documents")
def whitespace_normalize(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.collapse_space(F.col("text"))).alias("collapsed_md5"))


@PLANS.query("SELECT conv_id, turn, md5(coalesce(role, '') || chr(10) || coalesce(text, '')) AS joined_md5 FROM conversations")
def string_concat(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5(F.concat(F.coalesce("role", F.lit("")), F.chr(F.lit(10)), F.coalesce("text", F.lit("")))).alias("joined_md5"))


@PLANS.query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_type(props, '$.k') IS NOT NULL AS has_k FROM events")
def json_path(spark, sf_dir):
    value = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select("event_id", value.cast("bigint").alias("k"), value.isNotNull().alias("has_k"))


_LICENCE_URLS = """CASE doc_id % 9 WHEN 0 THEN 'https://creativecommons.org/licenses/by-sa/2.0/deed.ja' WHEN 1 THEN 'http://www.creativecommons.org/licenses/by-sa/2.0/' WHEN 2 THEN 'https://creativecommons.org/licenses/by-sa/2.0'
    WHEN 3 THEN 'https://creativecommons.org/licenses/by-nc/2.0/' WHEN 4 THEN 'https://example.org/licenses/by-sa/2.0/' WHEN 5 THEN 'ftp://creativecommons.org/licenses/by-sa/2.0/' WHEN 6 THEN 'https://creativecommons.org/licenses/by-sa/2.0/legalcode'
    WHEN 7 THEN 'https://creativecommons.org/licenses/by-sa/2.0/deed.ja/more' ELSE 'https://creativecommons.org/licenses/by-sa/2.5/' END"""
#: In SQL: whether an address u is the data licence's, by what is between its slashes.
_OWN_LICENCE = """(split_part(u, '/', 1) IN ('http:', 'https:') AND split_part(u, '/', 2) = '' AND split_part(u, '/', 3) IN ('creativecommons.org', 'www.creativecommons.org') AND split_part(u, '/', 4) = 'licenses' AND split_part(u, '/', 5) = 'by-sa'
    AND split_part(u, '/', 6) = '2.0' AND len(string_split(u, '/')) <= 7 AND (split_part(u, '/', 7) IN ('', 'legalcode') OR (starts_with(split_part(u, '/', 7), 'deed.') AND length(split_part(u, '/', 7)) > 5)))"""


@PLANS.query(f"SELECT doc_id, {_OWN_LICENCE} AS is_data_licence FROM (SELECT doc_id, {_LICENCE_URLS} AS u FROM documents)")
def is_data_license(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", licences.is_data_licence(F.expr(_LICENCE_URLS)).alias("is_data_licence"))


#: Declarations put behind the texts, so that every outcome occurs.
_DECLARED = """CASE doc_id % 8 WHEN 0 THEN ' (CC BY-SA 2.0)' WHEN 1 THEN ' Creative  Commons-BY NC 3.0.' WHEN 2 THEN ' https://creativecommons.org/licenses/by-sa/2.0/' WHEN 3 THEN ' https://creativecommons.org/licenses/by/4.0/'
    WHEN 4 THEN ' All rights  reserved' WHEN 5 THEN ' for non-commercial use' WHEN 6 THEN ' cc by, sa 2.0' ELSE '' END"""


@PLANS.query(f"""WITH d AS (SELECT doc_id, lower(coalesce(text, '') || {_DECLARED}) AS t, coalesce(text, '') || {_DECLARED} AS whole FROM documents),
    w AS (SELECT doc_id, whole, list_transform(string_split(trim(regexp_replace(regexp_replace(t, '[^a-z0-9_.\\s-]', ' | ', 'g'), '[\\s-]+', ' ', 'g')), ' '), lambda x: rtrim(x, '.')) AS words FROM d),
    c AS (SELECT doc_id, ' ' || array_to_string(words, ' ') AS spaced, list_filter(regexp_extract_all(whole, 'https?://[^\\s<>"'']+'), lambda u: split_part(u, '/', 3) IN ('creativecommons.org', 'www.creativecommons.org') AND split_part(u, '/', 4) = 'licenses' AND split_part(u, '/', 5) <> '') AS links,
        array_to_string(list_transform(words, lambda x: CASE x WHEN 'cc' THEN 'C' WHEN 'creative' THEN 'R' WHEN 'commons' THEN 'M' WHEN 'by' THEN 'B' WHEN 'sa' THEN 'S' WHEN '2.0' THEN 'V' ELSE CASE WHEN substr(x, 1, 1) BETWEEN '0' AND '9' THEN 'N' WHEN regexp_full_match(x, '[a-z]+') THEN 'L' ELSE 'x' END END), '') AS shape FROM w),
    n AS (SELECT doc_id, links, regexp_extract_all(shape, '(?:C|RM)B[CRMBSL]*[VN]') AS names, contains(spaced, ' all rights reserved') OR contains(spaced, ' noncommercial') OR contains(spaced, ' non commercial') OR contains(spaced, ' no copying') OR contains(spaced, ' no redistribution') AS restrictive FROM c)
    SELECT doc_id, CAST(len(names) AS INTEGER) AS n_names, CAST(len(links) AS INTEGER) AS n_links, restrictive,
        restrictive OR len(list_filter(links, lambda u: NOT {_OWN_LICENCE})) > 0 OR len(list_filter(names, lambda x: x NOT IN ('CBSV', 'RMBSV'))) > 0 AS conflict FROM n""")
def license_declaration(spark, sf_dir):
    whole = F.concat(F.coalesce("text", F.lit("")), F.expr(_DECLARED))
    rows = table(spark, sf_dir, "documents").select("doc_id", whole.alias("t"))
    return rows.select("doc_id", F.size(licences.names_in(F.col("t"))).alias("n_names"), F.size(licences.links_in(F.col("t"))).alias("n_links"), licences.restricts(F.col("t")).alias("restrictive"), licences.conflicts(F.col("t")).alias("conflict"))


@PLANS.query(f"""WITH l AS (SELECT doc_id, list_filter(regexp_extract_all(coalesce(text, '') || {_DECLARED}, 'https?://[^\\s<>"'']+'), lambda u: split_part(u, '/', 3) IN ('creativecommons.org', 'www.creativecommons.org') AND split_part(u, '/', 4) = 'licenses' AND split_part(u, '/', 5) <> '') AS links FROM documents)
    SELECT doc_id, CASE WHEN len(links) = 0 THEN 'none' WHEN len(list_filter(links, lambda u: NOT {_OWN_LICENCE})) = 0 THEN 'accepted' ELSE 'held' END AS outcome FROM l""")
def license_gate(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", licences.links_in(F.concat(F.coalesce("text", F.lit("")), F.expr(_DECLARED))).alias("links"))
    return rows.select("doc_id", F.when(licences.gate(F.col("links")), "accepted").when(F.size("links") == 0, "none").otherwise("held").alias("outcome"))


@PLANS.query(r"SELECT page_id, regexp_full_match(url, 'https?://[a-z.]*example\.(com|org)/[a-z]{2}/\d+(\?[^#]*)?') AS allowed FROM pages")
def allowed_url(spark, sf_dir):
    url = F.col("url")
    host = urls.part(url, "HOST").rlike(r"^[a-z.]*example\.(com|org)$")
    inside = urls.part(url, "PROTOCOL").isin("http", "https") & host & urls.part(url, "PATH").rlike(r"^/[a-z]{2}/\d+$") & urls.part(url, "REF").isNull()
    return table(spark, sf_dir, "pages").select("page_id", F.coalesce(inside, F.lit(False)).alias("allowed"))


@PLANS.query(r"""SELECT page_id, nullif(regexp_extract(r, '^https://[^/]+/web/(\d{14})(?:id_)?/(https?://.*)$', 1), '') AS stamp, nullif(regexp_extract(r, '^https://[^/]+/web/(\d{14})(?:id_)?/(https?://.*)$', 2), '') AS original
    FROM (SELECT page_id, 'https://archive.example.org/web/' || CASE WHEN page_id % 4 = 0 THEN '2015' ELSE '20150224000000' END || 'id_/' || url AS r FROM pages)""")
def feed_replay(spark, sf_dir):
    address = F.concat(F.lit("https://archive.example.org/web/"), F.when(F.col("page_id") % 4 == 0, "2015").otherwise("20150224000000"), F.lit("id_/"), F.col("url"))
    found = table(spark, sf_dir, "pages").select("page_id", urls.replay_parts(address).alias("r"))
    return found.select("page_id", F.col("r.timestamp").alias("stamp"), "r.original")


@PLANS.query(r"""SELECT page_id, regexp_extract(url, '://([^/]+)', 1) AS host, regexp_extract(url, '[?&]page=([^&#]*)', 1) AS page_no FROM pages""")
def url_parts(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", urls.part(url, "HOST").alias("host"), F.regexp_extract(url, r"[?&]page=([^&#]*)", 1).alias("page_no"))


@PLANS.query(r"""SELECT i, regexp_full_match(p, '(current|archive)/((entries|states)/([^./][^/]*/)*[^./][^/]*|(inventory|report)\.json)') AS allowed FROM (SELECT user_id AS i, CASE user_id % 5 WHEN 0 THEN 'current/entries/' || user_id || '.yaml' WHEN 1 THEN 'archive/states/x/' || user_id || '.yaml' WHEN 2 THEN 'current/inventory.json' WHEN 3 THEN 'current/../entries/a' ELSE 'other/entries/a' END AS p FROM events)""")
def bundle_path(spark, sf_dir):
    from inkspar.sources.bundle import allowed

    n = F.col("user_id").cast("string")
    path = F.when(F.col("user_id") % 5 == 0, F.concat(F.lit("current/entries/"), n, F.lit(".yaml"))).when(F.col("user_id") % 5 == 1, F.concat(F.lit("archive/states/x/"), n, F.lit(".yaml"))).when(F.col("user_id") % 5 == 2, "current/inventory.json").when(F.col("user_id") % 5 == 3, "current/../entries/a").otherwise("other/entries/a")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("i"), allowed(path, ("current", "archive"), ("entries", "states"), ("inventory.json", "report.json")).alias("allowed"))


@PLANS.query("""SELECT event_id, sha256('{"a":[1,null,{"p":"é","q":' || CAST(event_id AS VARCHAR) || '}],"props":{"k":' || json_extract_string(props, '$.k') || '},"type":"' || event_type || '"}') AS record_sha256 FROM events""")
def record_digest(spark, sf_dir):
    """Digest of the canonical form of JSON text: keys sorted, no spaces, signs as they are."""
    record = F.concat(F.lit('{ "type": "'), F.col("event_type"), F.lit('",  "props": '), F.col("props"), F.lit(', "a": [1, null, {"q": '), F.col("event_id").cast("string"), F.lit(', "p": "\\u00e9"}]}'))
    return table(spark, sf_dir, "events").select("event_id", text.record_digest(record).alias("record_sha256"))


@PLANS.query("""SELECT page_id, replace(url, '#', '%23') || '&q=a%20b%22%C3%A9%E6%97%A5' AS quoted FROM pages""")
def quote_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.quoted(F.concat(F.col("url"), F.lit('&q=a b"é日'))).alias("quoted"))


#: A scope that covers the test pages' addresses.
TEST_SCOPE = urls.Scope(hosts=("m.example.com", "www.example.org"), page_path="/view", label_field="label")


@PLANS.query(r"""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'te' || CAST(page_id AS VARCHAR) END AS label FROM pages""")
def original_label(spark, sf_dir):
    n = F.col("page_id").cast("string")
    address = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("http://m.example.com/VIEW?label=te"), n)).when(F.col("page_id") % 3 == 1, F.concat(F.lit("http://m.example.com/view?label=a&label="), n)).otherwise("http://m.example.com/view?label=a&x=1")
    return table(spark, sf_dir, "pages").select("page_id", urls.label_column(address, TEST_SCOPE).alias("label"))
