"""Omissions and their references, holds of feeds, nested records, destinations, reports, coverage of pages."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from inkspar import __main__ as cli
from inkspar import archive
from inkspar.operators import coverage, destinations, nested, omissions, reports
from inkspar.sources import published, records
from inkspar.streaming import holds
from tests.test_archive import written
from tests.test_pages import ENTRY, SCOPE


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


REVIEW = "response_sha256: string, source_url: string, label: string, id: bigint, section: string"


def test_validated_omissions(spark):
    review = ("r", "u", "l", 1, "Notes")
    reviews = spark.createDataFrame([review, review, ("r", "u", "l", 1, "Other"), ("z", "u", "l", 1, "Notes"), ("r", "u", "l", None, "Notes")], REVIEW.replace(":", ""))
    cases = [
        ("fits", ["r", "u", "l", 1], [review], ["header"], False, None), ("none", ["r", "u", "l", 1], [], ["Notes"], True, None), ("null", ["r", "u", "l", 1], None, ["Notes"], None, None),
        ("unmarked", ["r", "u", "l", 1], [review], [], None, "no mark of an incomplete source"), ("complete", ["r", "u", "l", 1], [review], [], True, "no mark of an incomplete source"), ("unknown", ["r", "u", "l", 1], [("r", "u", "l", 1, "Else")], [], False, "not reviewed"),
        ("response", ["r", "u", "l", 1], [("z", "u", "l", 1, "Notes")], [], False, "another response_sha256"), ("id", ["r", "u", "l", 2], [review], [], False, "another id"), ("idless", ["r", "u", "l", None], [("r", "u", "l", None, "Notes")], [], False, None),
        ("there", ["r", "u", "l", 1], [review, ("r", "u", "l", 1, "Other")], ["Other"], False, "the section is still there"), ("second", ["r", "u", "l", 1], [review, ("r", "u", "l", 1, "Else")], [], False, "not reviewed"),
    ]
    rows = spark.createDataFrame([(k, *own, o, kinds, marked) for k, own, o, kinds, marked, _ in cases], f"key string, response_sha256 string, source_url string, label string, id long, omissions array<struct<{REVIEW}>>, section_kinds array<string>, source_sections_complete boolean")
    assert {r["key"]: r["problem"] for r in omissions.validated(rows, reviews, "key").collect()} == {k: p for k, *_, p in cases}


def test_references_across_pieces(spark):
    rng = random.Random(4)
    bodies = ["", " a  b ", "x" * 20, "".join(rng.choice("ab é\n日😀") for _ in range(300))]
    clean = [" ".join(b.split()) for b in bodies]
    asked, want = [], {}
    for i in range(400):
        at, body = rng.randrange(-1, 25), rng.choice(clean)
        at = at if body != clean[3] else rng.randrange(-1, len(body) + 5)
        size = rng.randrange(0, 40)
        inside = size > 0 and 0 <= at and at + size <= len(body)
        wrong = rng.random() < 0.2
        gone = rng.random() < 0.1
        asked.append((i // 3, i % 3, "gone" if gone else sha(body), at, size, "x" if wrong else sha(body[max(at, 0) : max(at, 0) + size])))
        want[i // 3, i % 3] = "no body" if gone else "outside" if not inside else "differs" if wrong else "equal"
    passages = spark.createDataFrame(asked, "key long, place long, reference_sha256 string, offset long, length long, sha256 string")
    made = spark.createDataFrame([(sha(c), b) for c, b in zip(clean, bodies, strict=True)] * 2, "sha string, text string")
    for size in (7, 64):
        found = omissions.referenced(passages, omissions.pieces(made, "sha", "text", size), "key", size)
        assert {(r["key"], r["place"]): r["outcome"] for r in found.collect()} == want


def test_credit(spark):
    rows = spark.createDataFrame([("© Ann", False, [], True), (None, True, ["equal", "equal"], True), ("no", True, ["equal", "differs"], False), ("no", True, [], False), ("no", False, ["equal"], False), (None, None, None, False)], "shown string, own boolean, refs array<string>, want boolean")
    assert all(r["want"] == r["got"] for r in rows.withColumn("got", omissions.credit_holds(F.col("own"), F.col("shown"), "©", F.col("refs"))).collect())


@pytest.mark.parametrize("seed", range(3))
def test_holds_streamed_as_in_a_batch(spark, tmp_path, seed):
    """Rows in any order, late and twice, over several batches: after each, the last changes are what the batch form gives of all rows so far."""
    rng = random.Random(seed)
    rows = [(f"f{rng.randrange(5)}", rng.randrange(6), "begin", None, None) for _ in range(40)]
    rows += [(f"f{rng.randrange(5)}", rng.randrange(6), "result", rng.choice(["parsed", "parsed", "failed", None]), rng.choice(["a", "b", None])) for _ in range(40)]
    rows += [(None, 1, "begin", None, None), ("f1", None, "begin", None, None)]
    rng.shuffle(rows)
    frame = lambda part: spark.createDataFrame(part, holds.ATTEMPTS)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    changes = {}
    try:
        (tmp_path / "in").mkdir()
        source = spark.readStream.schema(holds.ATTEMPTS).parquet(str(tmp_path / "in"))

        def take(batch, _):
            for r in batch.collect():
                changes[r["feed_path"]] = tuple(r)

        query = holds.stream(source).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "c")).foreachBatch(take).start()
        for i in range(0, len(rows), 41):
            frame(rows[i : i + 41]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            query.processAllAvailable()
            assert sorted(changes.values()) == sorted(tuple(r) for r in holds.states(frame(rows[: i + 41])).collect())
        query.stop()
    finally:
        spark.conf.set(key, before)


def test_a_failed_refresh_holds_the_older_feed(spark):
    done = [("f", 1, "begin", None, None), ("f", 1, "result", "parsed", "a")]
    state = lambda *more: holds.states(spark.createDataFrame([*done, *more], holds.ATTEMPTS)).first()
    assert state()["exportable"] and state()["record_sha256"] == "a"
    for more in ([("f", 2, "begin", None, None)], [("f", 2, "begin", None, None), ("f", 2, "result", "failed", None)], [("f", 2, "begin", None, None), ("f", 1, "result", "parsed", "a")], [("f", 2, "result", "parsed", "b"), ("f", 2, "result", "review_required", "b")]):
        assert not state(*more)["exportable"]
    assert state(("f", 2, "result", "parsed", "b"))["record_sha256"] == "b"


def feeds_archive(tmp_path):
    """Two feeds' captures, of one an older capture too, and their bodies."""
    item = "<item><title>{0}</title><link>http://old.example.org/pages/viewOne.php?tagE={0}</link><description>x</description></item>"
    lines = []
    for path, stamp, label in (("n1", "20150225000000", "label"), ("n1", "20140101000000", "no"), ("n2", "20150225000000", "label")):
        body = f"<rss><channel><title>{path}{stamp}</title>{item.format(label)}</channel></rss>".encode()
        (tmp_path / "bodies").mkdir(exist_ok=True)
        (tmp_path / f"bodies/{path}{stamp}").write_bytes(body)
        original = f"http://old.example.org/rss/{path}.xml"
        lines.append({"label": None, "original": original, "timestamp": stamp, "archive_url": f"https://archive.example.org/web/{stamp}id_/{original}", "digest": "-", "retrieved_at": "now", "body_sha256": hashlib.sha256(body).hexdigest()})
    (tmp_path / "index").mkdir()
    return lines


def test_archive_feeds(spark, tmp_path, capsys):
    folders = written(tmp_path)
    lines = feeds_archive(tmp_path)
    out, states = str(tmp_path / "made"), f"file://{tmp_path}/states"
    options = ["--current", folders[1], "--host", "old.example.org", "--page-path", "/pages/viewOne.php", "--label-field", "tagE", "--feed-path", "/rss/n1.xml", "--feed-path", "/rss/n2.xml"]

    def run(rows):
        (tmp_path / "index/a.json").write_text("\n".join(map(json.dumps, rows)))
        code = cli.run(["archive-feeds", str(tmp_path / "index"), str(tmp_path / "bodies"), out, states, *options])
        return code, json.loads(capsys.readouterr().out)

    assert run(lines) == (0, {"parsed": 2})
    made = {p.stem: records.load(p.read_bytes()) for p in (tmp_path / "made").glob("*.yaml")}
    assert {k: [i["label"] for i in v["items"]] for k, v in made.items()} == {"rss-n1": ["label"], "rss-n2": ["label"]} and made["rss-n1"]["archive_timestamp"] == "20150225000000"
    assert archive.audit(spark, feed_folder=out, states=states)["export_ready"]
    # A newer capture without a body: the feed is held, its record of before too; the other one isn't touched.
    newer = lines[0] | {"timestamp": "20160101000000", "archive_url": lines[0]["archive_url"].replace("20150225000000", "20160101000000"), "body_sha256": "gone"}
    assert run([*lines[:2], newer]) == (1, {"failed": 1})
    found = {r["key"]: r["status"] for r in published.read(spark, states, archive.verification_schema()).collect()}
    assert found == {"/rss/n1.xml": "failed", "/rss/n2.xml": "parsed"}
    report = archive.audit(spark, feed_folder=out, states=states)
    assert not report["export_ready"] and report["checks"]["feeds held by states, holds or newer responses"] == 1
    # The first version of a run holds all its feeds before the work.
    before = published.read(spark, states, archive.verification_schema(), published.number(spark, states) - 1)
    assert {r["key"]: r["status"] for r in before.collect()} == {"/rss/n1.xml": "pending", "/rss/n2.xml": "parsed"}
    assert SCOPE.label_field == "tagE"


def test_paths_of_nested_records(spark):
    schema = "id long, kin array<struct<id: long, licence: struct<url: string>, kin: array<struct<id: long, licence: struct<url: string>>>>>"
    df = spark.createDataFrame([(1, [(2, ("a",), [(3, ("b",)), None]), (4, None, None), None]), (5, []), (6, None)], schema)
    assert nested.paths_of(df.schema, "kin") == ["kin", "kin.kin"]
    made = nested.with_path(df, "kin.kin.licence.url", F.concat(F.lit("x"), "id")).orderBy("id").collect()
    assert [k["licence"]["url"] for k in made[0]["kin"][0]["kin"] if k] == ["x1"] and made[0]["kin"][0]["licence"]["url"] == "a" and made[0]["kin"][0]["kin"][1] is None
    assert made[0]["kin"][1]["kin"] is None and made[0]["kin"][2] is None and made[1]["kin"] == [] and made[2]["kin"] is None
    made = nested.annotated(df, "kin", seen=F.lit("s")).filter("id = 1").first()
    assert made["seen"] == made["kin"][0]["seen"] == made["kin"][0]["kin"][0]["seen"] == "s" and nested.with_path(df, "id", F.lit(9)).first()["id"] == 9
    assert nested.with_path(df, "kin.licence.url", F.lit("n")).filter("id = 1").first()["kin"][1]["licence"] is None
    for path in ("none.x", "kin.none.x", "kin.id.x"):
        with pytest.raises(ValueError):
            nested.with_path(df, path, F.lit(1))


def test_children_share_provenance(spark):
    schema = "key long, id long, response_sha256 string, observation_kind string, additional_entries array<struct<id: long, response_sha256: string>>"
    rows = [(1, 10, "a", None, [(11, "a"), (12, "a")]), (2, 20, "a", None, [(21, "b")]), (3, 30, "a", "earlier", [(31, "a")]), (4, 40, None, None, [(41, None)]), (5, 50, "a", "earlier", []), (6, 60, "a", "x", None)]
    df = spark.createDataFrame(rows, schema)
    assert {r["key"]: r["foreign"] for r in nested.foreign_fields(df, "additional_entries").collect()} == {1: [], 2: ["response_sha256"], 3: ["observation_kind"], 4: [], 5: [], 6: []}
    flat = nested.expanded(df.filter("key NOT IN (2, 3)"), "additional_entries", "key").collect()
    assert sorted((r["key"], r["position"], r["record"]["id"]) for r in flat) == [(1, 0, 10), (1, 1, 11), (1, 2, 12), (4, 0, 40), (4, 1, 41), (5, 0, 50), (6, 0, 60)]
    with pytest.raises(Exception, match="another capture: response_sha256"):
        nested.expanded(df, "additional_entries", "key").collect()


def test_overlaps_against_brute_force(spark):
    rng = random.Random(9)
    paths = [(i, rng.choice(["", "/", "a//b", "a/b/", "./a", "/a", "/a/b", "/ab", "/a/b/c", "a/b/c", "/a/../b", "b", "/a/.", None])) for i in range(60)]
    tidy = {}
    for i, p in paths:
        if p is not None and ".." not in p.split("/"):
            tidy[i] = ("/" if p.startswith("/") else "") + "/".join(s for s in p.split("/") if s not in ("", "."))
    want = set()
    first = {}
    for i in sorted(tidy):
        if tidy[i] in first:
            want.add((first[tidy[i]], i, "equal"))
        first.setdefault(tidy[i], i)
    for i, p in tidy.items():
        for q, j in first.items():
            if p not in ("", "/") and p != q and (p.startswith(q.rstrip("/") + "/") if q else not p.startswith("/")):
                want.add((i, j, "inside"))
    got = destinations.overlaps(spark.createDataFrame(paths, "n int, path string"), "n", "path")
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


def test_build_refuses_overlapping_destinations(spark, tmp_path):
    folders = written(tmp_path)
    for out, extra in (("o", ["--pages", str(tmp_path / "o/pages")]), ("o", ["--sqlite", str(tmp_path / "o")]), ("p/o", ["--sqlite", str(tmp_path / "p" / "." / "o/x.db")])):
        assert cli.run(["build", str(tmp_path / out), *extra, *folders]) == 2
    assert not (tmp_path / "o").exists() and not (tmp_path / "p").exists()


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("parsed",), ("odd",), (None,), ("failed",)], "status string").repartition(3)
    out = str(tmp_path / "o")
    got = reports.observed_write(df, lambda d: d.write.parquet(out), **reports.crawl_metrics(F.col("status")))
    assert got == {"parsed": 1, "excluded": 0, "review_required": 0, "failed": 1, "pending": 0, "rows": 4, "unknown": 2, "complete": False} and spark.read.parquet(out).count() == 4
    with pytest.raises(Exception):
        reports.observed_write(df, lambda d: d.write.parquet(out), **reports.crawl_metrics(F.col("status")))
    empty = reports.observed_write(df.limit(0), lambda d: d.write.format("noop").mode("overwrite").save(), **reports.crawl_metrics(F.col("status")))
    assert empty["rows"] == 0 and empty["complete"] is False
    row = reports.one_row(df, crawl=got, other={"a": "x", "b": None})
    assert dict(row.dtypes)["crawl"].startswith("struct<parsed:bigint") and row.count() == 1


def test_unmapped_runs(spark):
    html = "<div>a<br>b <b>b</b><script>x</script><style>y</style><!-- z --> c </div>"
    got = spark.createDataFrame([(html,), (None,), ("",)], "h string").select(coverage.runs(F.col("h")).alias("r")).collect()
    assert [r["r"] for r in got] == [["a", "b", "b", "c"], [], []]
    shown, held = spark.createDataFrame([(1, ["a", "b", "b", "See"]), (2, []), (3, None)], "id long, runs array<string>"), spark.createDataFrame([(1, ["b", "c", "See"]), (4, ["d"])], "id long, runs array<string>")
    assert {tuple(r) for r in coverage.unmapped(shown, held, "id", ("See",)).collect()} == {(1, "a", 1), (1, "b", 1), (1, "c", -1), (1, "See", -1), (4, "d", -1)}


def test_audit_current(spark, tmp_path):
    written(tmp_path)
    page = ENTRY.replace(">x</span>", "></span>").replace("#3 Ann", "Ann").replace("Write a comment >", "").replace("eight</a>", "eight</a><p>lost by the parser</p>").replace("no</a>", "</a>")
    pages = spark.createDataFrame([(i, page.replace("editable_Main_7", f"editable_Main_{i}")) for i in (7, 8)], "id long, html string")
    index = spark.createDataFrame([(7,), (8,), (9,)], "id long")
    found, numbers = archive.audit_current(spark, str(tmp_path / "current"), pages, index)
    rows = {tuple(r) for r in found.collect()}
    assert (9, "no record", None) in rows and {(i, "text without a place", "lost by the parser") for i in (7, 8)} <= rows
    assert {r for r in rows if r[1] == "related id outside the index"} == set() and numbers["captured"] == 2 and numbers["pending"] == 1 and not numbers["coverage_verified"]
    few, _ = archive.audit_current(spark, str(tmp_path / "current"), pages, index.filter("id = 7"))
    assert {(r["id"], r["finding"]) for r in few.collect()} >= {(8, "related id outside the index"), (8, "not indexed")}


def test_audit_command_reads_pages(spark, tmp_path, capsys):
    from inkspar.sources import pages

    html = ENTRY
    (tmp_path / "bodies").mkdir()
    (tmp_path / "bodies/7").write_text(html)
    (tmp_path / "ids").mkdir()
    (tmp_path / "ids/a.json").write_text('{"id": 7}\n{"id": 9}')
    entry = pages.entry(html, 7, pages.Site("example", "site.example.org", "/g/"), "now") | {"warnings": []}
    records.write(str(tmp_path / "current/7.yaml"), entry)
    assert cli.run(["audit", "--current", str(tmp_path / "current"), "--bodies", str(tmp_path / "bodies"), "--ids", str(tmp_path / "ids")]) == 1
    report = json.loads(capsys.readouterr().out)
    assert report["checks"]["current: no record"] == 1 and report["checks"]["current: records without their page's bytes"] == 0 and report["coverage"]["pending"] == 1
    assert report["checks"]["current: related id outside the index"] == 1 and not report["export_ready"]
