"""Stores, published tables, inventories from gzip members, audits with states, prefix trees and as-of joins."""

import gzip
import hashlib
import json
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inkspar import __main__ as cli
from inkspar import archive
from inkspar.operators import gates, hashtree, history, inventories, verification
from inkspar.plans import verified
from inkspar.sources import cdx, gzindex, objects, published, records
from tests.test_archive import written
from tests.test_pages import CAPTURE, LICENCE, legacy


def sha(data):
    return hashlib.sha256(data).hexdigest()


def rows_of(bodies, stated=None):
    data = sorted((sha(b), len(b), b, (stated or {}).get(b)) for b in bodies)
    return pa.RecordBatch.from_pylist([dict(zip(("sha256", "size", "body", "stated"), r, strict=True)) for r in data], schema=pa.schema([("sha256", pa.string()), ("size", pa.int64()), ("body", pa.binary()), ("stated", pa.string())]))


def test_store(spark, tmp_path):
    root = f"file://{tmp_path}/s"
    made = lambda bodies: spark.createDataFrame([(b,) for b in bodies], "body binary").repartition(3)
    held = lambda: {(r["sha256"], r["size"], bytes(r["body"])) for r in objects.read(spark, root).collect()}
    one, two = [b"a", b"a", b"", None, b"b" * 70_000], [b"a", b"c", b"c"]
    assert objects.read(spark, root).count() == 0 and objects.commits(root) == []
    objects.store(made(one), root)
    assert held() == {(sha(b), len(b), b) for b in one if b is not None} and objects.commits(root) == ["00000001"]
    objects.store(made(two), root)
    objects.store(made(two), root)
    assert held() == {(sha(b), len(b), b) for b in [*one, *two] if b is not None} and objects.commits(root) == ["00000001", "00000002"]
    assert objects.read(spark, root).count() == 4 and {r["outcome"] for r in objects.verified(spark, root).collect()} == {"equal"}
    with pytest.raises(Exception, match="has the hash"):
        objects.store(spark.createDataFrame([(b"new", sha(b"new")), (b"d", sha(b"e"))], "body binary, sha string"), root, stated="sha")
    assert objects.read(spark, root).count() == 4 and len(objects.commits(root)) == 2 and not list((tmp_path / "s/staged").glob("*"))
    with pytest.raises(Exception, match="never replaced"):
        made(one).write.format(objects.FORMAT).mode("overwrite").option("path", root).save()


def test_store_attempts(spark, tmp_path):
    """A task that was tried again, one that fails half-way, and two jobs at a time."""
    root = f"file://{tmp_path}"
    bodies = [bytes([i]) * 50 for i in range(200)]
    writer = objects.PackWriter(root, 1, "job", [])
    writer.write(iter([rows_of(bodies)]))  # its message is lost
    message = writer.write(iter([rows_of(bodies * 2)]))
    assert (message.objects, message.repeated, len(message.packs)) == (200, 200, 16)

    def breaks():
        yield rows_of([b"x"])
        raise OSError("lost")

    with pytest.raises(OSError):
        writer.write(breaks())
    writer.commit([message, None])
    assert objects.read(spark, root).count() == 200 and len(list(tmp_path.glob("commits/*/*.parquet"))) == 16 and not list(tmp_path.glob("staged/*"))
    first, second = objects.PackWriter(root, 1, "one", ["00000001"]), objects.PackWriter(root, 1, "two", ["00000001"])
    a, b = first.write(iter([rows_of([*bodies[:9], b"n"])])), second.write(iter([rows_of([b"n"])]))
    assert (a.objects, a.known) == (1, 9)
    first.commit([a])
    with pytest.raises(objects.Conflict, match="another commit"):
        second.commit([b])
    third = objects.PackWriter(root, 1, "three", ["00000001", "00000002"])
    third.abort([third.write(iter([rows_of([b"z"])]))])
    assert objects.read(spark, root).count() == 201 and not list(tmp_path.glob("staged/*"))
    bad = third.write(iter([rows_of([b"y", b"z"], {b"z": "0"})]))
    with pytest.raises(objects.Conflict):
        third.commit([bad])
    small = objects.PackWriter(root, 1, "four", ["00000001", "00000002"], pack_bytes=60)
    rows = [rows_of([b]) for b in sorted((bytes([i, 1]) * 40 for i in range(30)), key=sha)]
    done = small.write(iter(rows))
    assert done.objects == 30 and len(done.packs) > 16
    # One object too many, and one that isn't what it says.
    pack = next(tmp_path.glob("commits/00000001/*.parquet"))
    (tmp_path / "commits/00000009").mkdir()
    (tmp_path / "commits/00000009/again.parquet").write_bytes(pack.read_bytes())
    assert {r["outcome"] for r in objects.verified(spark, root).collect()} == {"equal", "repeated"}


def test_published(spark, tmp_path):
    root, df = f"file://{tmp_path}/t", spark.range(3)
    assert published.number(spark, root) == 0 and published.read(spark, root, "id long").count() == 0
    assert published.publish(df, root, 0) == 1 and published.publish(spark.range(5), root, 1) == 2
    assert published.read(spark, root, "id long").count() == 5 and published.read(spark, root, "id long", 1).count() == 3
    with pytest.raises(published.Moved):
        published.publish(spark.range(9), root, 1)
    assert published.read(spark, root, "id long").count() == 5 and len(list((tmp_path / "t/versions").iterdir())) == 2
    with pytest.raises(Exception):  # a job that fails before the pointer moves leaves the version that holds
        published.publish(spark.range(3).select(F.raise_error(F.lit("x")).alias("id")), root, 2)
    assert published.number(spark, root) == 2


def split_at(text, cuts):
    return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]


@pytest.mark.parametrize("seed", range(4))
def test_gzip_members(spark, tmp_path, seed):
    rng = random.Random(seed)
    want, members = [], []
    for name in ("a", "b"):
        text = b"\n".join(bytes(rng.choices(b"abc\xc3\xa9 ", k=rng.randrange(30))).replace(b"\xc3", b"").replace(b"\xa9", b"") + "é日".encode() * rng.randrange(3) for _ in range(400)) + b"\n" * rng.randrange(2)
        cuts = sorted(rng.sample(range(200, len(text)), 12))
        cuts = [c for i, c in enumerate(cuts) if i == 0 or c - cuts[i - 1] > 80]
        parts = split_at(text, cuts)
        if rng.random() < 0.5:
            at = next((i for i, p in enumerate(parts) if p.endswith(b"\n")), len(parts))
            parts.insert(at + 1, b"")  # a member without content, behind a whole line or the end
        (tmp_path / f"{name}.gz").write_bytes(b"".join(gzip.compress(p, level) for p, level in zip(parts, rng.choices(range(10), k=len(parts)), strict=True)))
        members.append(len(parts))
        lines = text.split(b"\n")
        want += [x.decode() for x in (lines if lines[-1] else lines[:-1])]
    for split in (300, 1 << 20):
        found = gzindex.pieces(spark, f"file://{tmp_path}", split)
        got = gzindex.lines(found).collect()
        assert sorted(r["line"] for r in got) == sorted(want)
        assert found.select("file", "member").distinct().count() == sum(members) and len({(r["file"], r["member"], r["place"]) for r in got}) == len(got)
        in_order = [r["line"] for r in sorted(got, key=lambda r: (r["file"], r["member"], r["place"]))]
        assert in_order == want


def test_gzip_members_refused(spark, tmp_path):
    good, root = gzip.compress(b"one\ntwo\n" * 50), f"file://{tmp_path}/x.gz"
    for data, problem in ((good + b"junk" + good, "gap|no gzip member"), (b"junk" + good, "no gzip member"), (good[:-9], "no gzip member|gap"), (b"".join(gzip.compress(p) for p in (b"a", b"b", b"c\n")), "over more than two members"), (gzip.compress(b"x" * 70_000 + b"\n"), "a line of over")):
        (tmp_path / "x.gz").write_bytes(data)
        with pytest.raises(Exception, match=problem):
            gzindex.lines(gzindex.pieces(spark, root, 40)).collect()
    # A stored (not deflated) member that holds another gzip member's bytes: that is no member of the file.
    (tmp_path / "x.gz").write_bytes(gzip.compress(b"q" * 500 + b"\n", 0) + gzip.compress(good.replace(b"\n", b"") + b"\n", 0))
    starts = {r["member"] for r in gzindex.pieces(spark, root, 1 << 20).collect()}
    assert len(starts) == 2
    (tmp_path / "none").mkdir()
    assert gzindex.pieces(spark, f"file://{tmp_path}/none").count() == 0
    (tmp_path / "x.gz").write_bytes(gzip.compress(b"not a header\nx\n"))
    with pytest.raises(ValueError, match="without the header"):
        cdx.member_lines(spark, root)


def test_inventory_verdict(spark):
    rows = spark.createDataFrame([("a", 1, "2", "o")] + [("b", i, str(9 - i), "o") for i in range(3)] + [("c", 0, "1", "o"), ("c", 1, "2", "o")], "label string, position long, timestamp string, original string")
    assert {(r["label"], r["position"]) for r in inventories.out_of_order(rows).collect()} == {("a", 1), ("c", 1)}
    outcomes = spark.createDataFrame([("a", "equal"), ("b", "missing")], "label string, outcome string")
    one = inventories.verdict(outcomes, rows.limit(0), F.struct(F.lit(1)), F.struct(F.lit(1))).first()
    assert (one["captures"], one["wrong"], one["disordered"], one["counts_agree"], one["verified"]) == (2, 1, 0, True, False)
    lines = spark.createDataFrame([(i,) for i in range(5)], "place long")
    assert inventories.totals(lines, outcomes).first().asDict() == {"index_rows": 4, "capture_count": 2, "label_count": 2}


def test_one_state(spark):
    states = spark.createDataFrame([("a", "parsed", "1"), ("a", "failed", "2"), ("b", "parsed", "2"), ("b", "parsed", "1"), (None, "parsed", "1")], "key string, status string, sha string")
    assert {(r["key"], r["status"], r["sha"]) for r in gates.one_state(states, "key").collect()} == {("a", "failed", "2"), ("b", "parsed", "1"), (None, "parsed", "1")}


def brute_as_of(left, right):
    out = []
    for i, by, at in left:
        found = [(since, v) for b, since, v in right if b == by and by is not None and at is not None and since is not None and since <= at]
        out.append((i, by, at, max(found, key=lambda p: (p[0], p[1] is not None, p[1] or 0))[1] if found else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_as_of_against_brute_force(spark, seed):
    """One key has most of all rows; times repeat, keys and times can be null."""
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot"] * 8 + ["a", "b", None])
    left = [(i, key(), rng.choice([None, *range(60)])) for i in range(400)]
    right = sorted({(key(), rng.choice([None, *range(60)]), rng.randrange(100)) for _ in range(120)}, key=str)
    a, b = spark.createDataFrame(left, "i long, by string, at long"), spark.createDataFrame(right, "by string, since long, v long")
    for ranges in (1, 16):
        got = history.as_of(a, b, "by", "at", "since", ["v"], ranges)
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute_as_of(left, right) and got.columns == ["i", "by", "at", "v"]
    assert {r["v"] for r in history.as_of(a, b.limit(0), "by", "at", "since", ["v"]).collect()} == {None} and history.as_of(a.limit(0), b, "by", "at", "since", ["v"]).count() == 0
    with pytest.raises(ValueError):
        history.as_of(a, b.withColumnRenamed("v", "i"), "by", "at", "since", ["i"])


def test_prefix_tree(spark):
    rng = random.Random(2)
    schema = "k long, name string, v double"
    rows = [(i % 900, rng.choice(["x", "", None]), float(i)) for i in range(1000)] + [(None, "n", 1.0), (5, "same", 2.0), (5, "same", 2.0)]
    other = [r for r in rows if r[0] not in (7, 8)] + [(5, "same", 2.0), (2000, "x", 1.0)]
    other = [(k, None if n == "" and k == 11 else n, v) for k, n, v in other]
    other.remove((None, "n", 1.0))
    a, b = spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema)
    same = a.orderBy("v").select("v", "k", "name").repartition(7)
    assert hashtree.differing(hashtree.tree(a, ["k"]), hashtree.tree(same, ["k"])).count() == 0 and hashtree.compared(a, same, ["k"]).count() == 0
    key = lambda rs: {k: sorted((r for r in rs if r[0] == k), key=str) for k in {r[0] for r in rs}}
    x, y = key(rows), key(other)
    want = {(k, "missing" if k not in y else "unexpected" if k not in x else "changed") for k in {*x, *y} if x.get(k) != y.get(k)}
    for depth in (1, 4):
        assert {tuple(r) for r in hashtree.compared(a, b, ["k"], depth).collect()} == want
    nodes = hashtree.differing(hashtree.tree(a, ["k"], 2), hashtree.tree(b, ["k"], 2), 2).collect()
    assert {r["level"] for r in nodes} == {0, 1, 2} and len(nodes) < 20
    tree = hashtree.tree(a, ["k"], 3)
    assert tree.filter("level = 0").first()["n"] == len(rows) and {r["n"] for r in tree.groupBy("level").agg(F.sum("n").alias("n")).collect()} == {len(rows)}
    assert hashtree.compared(a.limit(0), a.limit(0), ["k"]).count() == 0 and hashtree.compared(a, a.limit(0), ["k"]).count() == len(x)


def captured(tmp_path, n=2):
    """n pages in a folder of bodies, and their index."""
    (tmp_path / "bodies").mkdir()
    (tmp_path / "index").mkdir()
    lines = []
    for i in range(n):
        page = (legacy() + LICENCE + f"<!-- {i} -->").encode()
        (tmp_path / f"bodies/{i}").write_bytes(page)
        lines.append(CAPTURE | {"retrieved_at": "now", "body_sha256": sha(page), "timestamp": f"2015022{i}000000", "archive_url": f"https://archive.example.org/web/2015022{i}000000id_/{CAPTURE['original']}"})
    (tmp_path / "index/a.json").write_text("\n".join(map(json.dumps, lines)))
    return str(tmp_path / "index"), str(tmp_path / "bodies"), str(tmp_path / "out")


def test_archive_audit_writes_all_states_or_none(spark, tmp_path, capsys):
    index, bodies, out = captured(tmp_path, 1)
    states = f"file://{tmp_path}/published"
    assert cli.run(["extract", index, bodies, out, str(tmp_path / "lines")]) == 0
    capsys.readouterr()
    audit = lambda *more: (cli.run(["archive-audit", index, bodies, out, states, *more]), json.loads(capsys.readouterr().out))
    code, report = audit()
    assert code == 1 and report == {"records": 1, "errors": 0, "warnings": 0, "blocked": 0, "unverified": 1, "verified": True, "states_written": 0, "export_ready": False}
    (stored,) = (tmp_path / "out").glob("*.yaml")
    whole = records.load(stored.read_bytes())
    (tmp_path / "held").mkdir()
    (tmp_path / "held/a.json").write_text(json.dumps({"key": stored.stem, "hold": "failed"}))
    assert audit("--write-states", "--holds", str(tmp_path / "held"))[1]["blocked"] == 1 and published.number(spark, states) == 0
    for change in ({"title": "other"}, {"warnings": ["w"]}, {"latest_indexed_timestamp": "20990101000000"}):
        records.write(str(stored), whole | change)
        code, report = audit("--write-states")
        assert code == 1 and not report["verified"] and published.number(spark, states) == 0
    records.write(str(stored), whole)
    code, report = audit("--write-states")
    assert code == 0 and report["states_written"] == 1 and report["export_ready"] and published.number(spark, states) == 1
    assert audit("--write-states")[1]["states_written"] == 0 and published.number(spark, states) == 1
    assert archive.audit(spark, archive_folder=out, states=states)["export_ready"]
    records.write(str(stored), whole | {"title": "other"})
    report = archive.audit(spark, archive_folder=out, states=states)
    assert not report["export_ready"] and report["checks"]["observations held by states, holds or newer responses"] == 1


def test_feeds_are_held_by_states(spark, tmp_path):
    folders = written(tmp_path)
    feeds = str(tmp_path / "feeds")
    (tmp_path / "s").mkdir()
    state = {r["key"]: r["record_sha256"] for r in archive._judged(archive.feeds(spark, feeds)).collect()}
    for status, ready in (("parsed", True), ("pending", False), ("failed", False)):
        (tmp_path / "s/a.json").write_text("\n".join(json.dumps({"key": k, "status": status, "record_sha256": d}) for k, d in state.items()))
        assert archive.audit(spark, feed_folder=feeds, states=str(tmp_path / "s"))["export_ready"] is ready
    assert folders


def test_a_bad_record_holds_its_batch(spark):
    states = spark.createDataFrame([("a", "failed", "1")], "key string, status string, record_sha256 string")
    for c in verification.STATE[2:]:
        states = states.withColumn(c, F.lit(None).cast("string"))
    new = states.withColumn("status", F.lit("parsed")).unionByName(states.withColumn("key", F.lit("b")).withColumn("status", F.lit("parsed")))
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "key string, batch long")
    for good, want in (([], {"a": "failed"}), ([2], {"a": "failed", "b": "parsed"}), ([1, 2], {"a": "parsed", "b": "parsed"})):
        judged = spark.createDataFrame([(b, b in good) for b in (1, 2)], "batch long, verified boolean")
        assert {r["key"]: r["status"] for r in verification.settled(states, new, rows, judged, "key", "batch").collect()} == want


def test_extract_follows_decisions(spark, tmp_path, capsys):
    """Pages of other categories by a verified id, a review, a review of another response, and a page with a section left out."""
    from inkspar.sources import legacy_pages

    (tmp_path / "bodies").mkdir()
    (tmp_path / "index").mkdir()
    cell = '<div><span class="titleSection">Tutorial:</span> long text</div>'
    unclassified = "<b>Category</b> <i>grammar</i>"
    pages = {
        "verified": legacy("verified", 1, "flash"), "outside": legacy("outside", 2, "flash"), "reviewed": legacy("reviewed", 3).replace(unclassified, ""), "refused": legacy("refused", 4), "elsewhere": legacy("elsewhere", 5),
        "omitted": legacy("omitted", 6) + cell, "plain": legacy("plain", 7), "unsaid": legacy("unsaid", 8).replace(unclassified, ""),
    }
    bodies = {name: (html + LICENCE).encode() for name, html in pages.items()}
    address = lambda name: f"http://old.example.org/pages/viewOne.php?tagE={name}"
    lines = []
    for name, body in bodies.items():
        (tmp_path / "bodies" / name).write_bytes(body)
        lines.append({"label": name, "original": address(name), "timestamp": "20150225000000", "archive_url": f"https://archive.example.org/web/20150225000000id_/{address(name)}", "digest": "-", "retrieved_at": "now", "body_sha256": sha(body)})
    (tmp_path / "index/a.json").write_text("\n".join(map(json.dumps, lines)))
    review = lambda name, number, decision, category, response: {"id": number, "label": name, "decision": decision, "category": category, "expected_title": f"name [yomi] ({name})", "captures": [{"source_url": address(name), "response_sha256": response}]}
    given = [review("reviewed", 3, "grammar", None, "x"), review("refused", 4, "non-grammar", "grammar", sha(bodies["refused"])), review("elsewhere", 5, "non-grammar", "grammar", "another"), review("plain", 99, "non-grammar", "grammar", "x")]
    at = bodies["omitted"].index(cell.encode())
    omission = {"response_sha256": sha(bodies["omitted"]), "source_url": address("omitted"), "label": "omitted", "id": 6, "section": "Tutorial", "byte_offset": at, "byte_length": len(cell), "range_sha256": sha(cell.encode()), "text_sha256": sha(b"Tutorial: long text")}
    for folder, rows in (("reviews", given), ("omissions", [omission])):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a.json").write_text("\n".join(map(json.dumps, rows)))
    from inkspar.sources import pages as current_pages
    from tests.test_pages import ENTRY, SITE

    records.write(str(tmp_path / "current/1.yaml"), current_pages.entry(ENTRY.replace("editable_Main_7", "editable_Main_1"), 1, SITE, "now") | {"warnings": []})
    options = ["--reviews", str(tmp_path / "reviews"), "--omissions", str(tmp_path / "omissions"), "--current", str(tmp_path / "current")]
    folders = [str(tmp_path / n) for n in ("index", "bodies", "out")]
    assert cli.run(["extract", *folders, str(tmp_path / "states"), *options]) == 1
    capsys.readouterr()
    keys = {name: hashlib.sha256("\0".join((name, "20150225000000", address(name))).encode()).hexdigest()[:32] for name in pages}
    states = {r["key"]: (r["status"], r["reason"]) for r in spark.read.json(str(tmp_path / "states")).collect()}
    found = {name: states[k] for name, k in keys.items()}
    assert {n: s for n, (s, _) in found.items()} == {"verified": "parsed", "outside": "excluded", "reviewed": "parsed", "refused": "excluded", "elsewhere": "review_required", "omitted": "parsed", "plain": "parsed", "unsaid": "review_required"}
    assert found["elsewhere"][1] == "the response isn't one that was reviewed"
    made = {name: records.load((tmp_path / f"out/{keys[name]}.yaml").read_bytes()) for name in ("omitted", "reviewed")}
    assert made["omitted"]["omitted_sections"] == [omission] and made["omitted"]["source_sections_complete"] is False and made["reviewed"]["membership_review"]["decision"] == "grammar"
    assert cli.run(["audit-captures", *folders, *options]) == 0 and json.loads(capsys.readouterr().out) == {"equal": 4}
    assert cli.run(["audit-captures", *folders]) == 1
    capsys.readouterr()
    assert legacy_pages.ADMITTED == ("grammar", "lesson")


def test_historical_records_for_an_export(spark, tmp_path, capsys):
    """The newest capture's record, an earlier one with a reason, and what keeps each from an export."""
    index, bodies, out = captured(tmp_path, 2)
    assert cli.run(["extract", index, bodies, out, str(tmp_path / "lines")]) == 0
    capsys.readouterr()
    paths = {records.load(p.read_bytes())["archive_timestamp"]: p for p in (tmp_path / "out").glob("*.yaml")}
    old, new = paths["20150220000000"], paths["20150221000000"]

    def read(**options):
        digests = {r["key"]: r["record_sha256"] for r in archive._judged(archive.observations(spark, out)).collect()}
        (tmp_path / "s").mkdir(exist_ok=True)
        (tmp_path / "s/a.json").write_text("\n".join(json.dumps({"key": k, "status": "parsed", "record_sha256": d}) for k, d in digests.items()))
        return archive.read_archive_records(spark, out, True, index=index, states=str(tmp_path / "s"), **options)

    with pytest.raises(ValueError, match="not bound to the index: 1"):
        read()
    whole = records.load(old.read_bytes()) | {"archive_digest": "-"}
    records.write(str(old), whole | {"observation_kind": archive.EARLIER, "selection_reason": "other text"})
    assert read().count() == 2 and [r["archive_timestamp"] for r in read(include_earlier=False).collect()] == ["20150221000000"]
    for change, problem in (({"selection_reason": " "}, "not bound"), ({"archive_timestamp": "20150219000000"}, "not bound"), ({"additional_entries": [{**whole, "response_sha256": "0" * 64}]}, "another capture than their page's: 3")):
        records.write(str(old), whole | {"observation_kind": archive.EARLIER, "selection_reason": "other text"} | change)
        with pytest.raises(ValueError, match=problem):
            read()
    assert archive.read_archive_records(spark, out).count() == 3 and new.exists()
    with pytest.raises(ValueError):
        archive.read_archive_records(spark, out, True, states=str(tmp_path / "s"))
    assert not archive.audit(spark, archive_folder=out)["export_ready"]


def test_snapshot_of_a_backup(spark, tmp_path):
    """Records are read only if inventory, index and members agree."""
    from inkspar.functions.urls import Scope

    scope = Scope(hosts=("old.example.org",), page_path="/pages/viewOne.php", label_field="tagE")
    container = archive.Container("c.warc.gz", "20150224000000", "20150302235959")
    original = CAPTURE["original"]
    line = lambda stamp, offset: f"k {stamp} {original} text/html 200 {'A' * 32} - - 100 {offset} c.warc.gz"
    text = "\n".join([cdx.HEADER, line("20150224000000", 5), line("20150225000000", 900), line("20150225000000", 901)]).encode() + b"\n"
    (tmp_path / "index").mkdir()
    (tmp_path / "index/i.gz").write_bytes(b"".join(gzip.compress(text[a : a + 200]) for a in range(0, len(text), 200)))
    address = lambda stamp: f"https://archive.example.org/web/{stamp}id_/{original}"
    good = [{"label": "te", "position": i, "timestamp": s, "original": original, "digest": "A" * 32, "archive_url": address(s), "warc_offset": o, "warc_length": 100} for i, (s, o) in enumerate((("20150225000000", 900), ("20150224000000", 5)))]
    record = {"label": "te", "id": 978, "archive_timestamp": "20150225000000", "response_sha256": "r", "warnings": [], "retrieval": {"offset": 900, "length": 100, "member_sha256": "0" * 64}}
    (tmp_path / "stored").mkdir()

    def read(rows, change=None):
        (tmp_path / "stored/a.json").write_text("\n".join(map(json.dumps, rows)))
        records.write(str(tmp_path / "records/a.yaml"), record | (change or {}))
        return archive.read_archive_snapshot(spark, str(tmp_path / "records"), f"file://{tmp_path}/index", str(tmp_path / "stored"), scope, container)

    assert read(good).count() == 1
    for rows, problem in ((good[:1], "differ from the index: 1"), ([good[0] | {"warc_offset": 901}, good[1]], "differ from the index: 1"), ([good[0] | {"position": 1}, good[1] | {"position": 0}], "out of order: 1"), ([*good, good[1] | {"label": "x", "position": 0}], "differ from the index: 1")):
        with pytest.raises(ValueError, match=problem):
            read(rows)
    for change in ({"retrieval": {"offset": 5, "length": 100, "member_sha256": "0" * 64}}, {"retrieval": {"offset": 900, "length": 100}}, {"archive_timestamp": "20150224000000"}, {"label": "no"}):
        with pytest.raises(ValueError, match="records of other members: 1"):
            read(good, change)
    with pytest.raises(ValueError, match="break a bound"):
        archive.read_archive_snapshot(spark, str(tmp_path / "records"), f"file://{tmp_path}/index", str(tmp_path / "stored"), scope, archive.Container("c.warc.gz", "20150225000000", "20150302235959"))


def test_index_files_are_unpacked_once(spark, tmp_path):
    """All checks and readers of an index's lines share one reading of its members."""
    text = "\n".join([cdx.HEADER, *(f"k {i} c" for i in range(200))]).encode() + b"\n"
    (tmp_path / "a.gz").write_bytes(b"".join(gzip.compress(text[i : i + 300]) for i in range(0, len(text), 300)))
    lines = cdx.member_lines(spark, f"file://{tmp_path}")
    assert sorted(int(r["fields"][1]) for r in lines.collect()) == list(range(200))
    (tmp_path / "a.gz").unlink()
    assert lines.filter("size(fields) = 3").count() == 200


def test_named_rows_meet_without_a_join(spark):
    """Rows below differing leaves are added up, a repeated or null key too, and only the leaves are broadcast to them."""
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (None, "n"), (4, "same")], "k int, v string")
    b = spark.createDataFrame([(1, "x2"), (2, "y"), (None, "m"), (3, "z"), (4, "same")], "k int, v string")
    leaves = hashtree.differing(hashtree.tree(a, ["k"], 1), hashtree.tree(b, ["k"], 1), 1)
    found = hashtree.named(a, b, leaves, ["k"], 1)
    assert {tuple(r) for r in found.collect()} == {(1, "changed"), (2, "changed"), (None, "changed"), (3, "unexpected")}
    plan = hashtree.named(a, b, spark.createDataFrame([(1, "a")], "level int, prefix string"), ["k"], 1)._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and plan.count("BroadcastHashJoin") == 2


def test_each_history_is_joined_once(spark):
    """The as-of joins before the last one are stored: read again, each would make all those before it three times."""
    import __spark_entry__ as entry

    plan = entry.queries()["earlier_observations"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Window \[", plan)) == 2


def test_hashes_stay_out_of_joins_by_label(spark):
    """What is compared by key is said there: no hash goes through the joins with the inventory."""
    t = verified._audited(spark, "/root/testdata/sf0.001")
    found = verification.findings(t["records"], t["extracted"], t["states"].limit(5), t["holds"], t["captures"], t["cached"], "event_id")
    joins, ahead = [], [found._jdf.queryExecution().sparkPlan()]
    while ahead:
        node = ahead.pop()
        kids = [node.children().apply(i) for i in range(node.children().size())]
        ahead += kids
        if "Join" in node.nodeName() and re.search(r"\[label#", node.toString().split("\n")[0]):
            joins.append(" ".join(k.output().mkString(",") for k in kids))
    assert len(joins) == 2 and not any("sha256" in names or "again" in names or "state" in names for names in joins)
