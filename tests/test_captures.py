import base64
import gzip
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from inkspar.functions.urls import Scope
from inkspar.operators import captures, pacing
from inkspar.sources import cdx, member

SCOPE = Scope(hosts=("pages.example.org",), page_path="/view.php", label_field="t", feed_paths=("/feed.xml",))


def test_labels_and_replay():
    assert SCOPE.label("http://pages.example.org/VIEW.php?t=te%20x&date=2010-1-2") == "te x"
    for bad in ("ftp://pages.example.org/view.php?t=a", "http://other.example.org/view.php?t=a", "http://pages.example.org:81/view.php?t=a", "http://pages.example.org/view.php?t=a&t=b", "http://pages.example.org/view.php?t=", "http://pages.example.org/view.php?t=a&z=1", "http://pages.example.org/view.php?t=a#f", "http://pages.example.org/view.php?t=a&date=x", None, "http://[bad"):
        assert SCOPE.label(bad) is None
    address = SCOPE.archive_url("20150224000000", "http://pages.example.org/view.php?t=a b")
    assert address.endswith("a%20b") and SCOPE.replay(address.replace("%20", "b")) == ("20150224000000", "http://pages.example.org/view.php?t=abb")
    assert SCOPE.replay("https://archive.example.org/web/20150224000000id_/http://pages.example.org/feed.xml") and SCOPE.replay("https://archive.example.org/web/2015id_/http://pages.example.org/feed.xml") is None


def rows(spark, found):
    return spark.createDataFrame(found, "label string, timestamp string, original string, digest string, archive_url string")


def test_selection(spark):
    d1, d2 = "A" * 32, "B" * 32
    found = rows(spark, [("x", "3", "o3", d1, "u3"), ("x", "2", "o2", d1, "u2"), ("x", "1", "o1", d1, "u1"), ("x", "0", "o0", d1, "u0"), ("x", "1", "p1", d2, "v1"), ("x", "9", "q", "-", "w1"), ("x", "8", "q", "-", "w2"), ("y", "1", "o", "bad", "z1"), ("y", "0", "o", "bad", "z0")])
    newest = {r["archive_url"] for r in captures.ranked(found).filter("copy = 1").collect()}
    assert newest == {"u3", "v1", "w1", "w2", "z1"} == {r["archive_url"] for r in captures.newest(found).collect()}
    order = {k: [r["archive_url"] for r in captures.candidates(found).filter(F.col("label") == k).orderBy("attempt").collect()] for k in "xy"}
    assert order == {"x": ["w1", "w2", "u3", "u2", "u1"], "y": ["z1"]}
    body = b"page"
    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    listed = rows(spark, [("x", "2", "o", digest, "u2"), ("x", "1", "o", digest, "u1"), ("y", "1", "o", "-", "u3")])
    bodies = spark.createDataFrame([("x", "1", "o", "u1", body), ("x", "1", "o", "other", body), ("x", "1", "o", "u1", b"z"), ("y", "1", "o", "u3", body)], "label string, timestamp string, original string, archive_url string, body binary")
    assert sorted((r["archive_url"], bytes(r["body"]), r["equal"]) for r in captures.equals_latest(bodies, listed).collect()) == [("other", body, False), ("u1", body, True), ("u1", b"z", False), ("u3", body, False)]


def test_latest_of_a_capture_listed_twice(spark):
    """A capture that the index lists with two digests gives one row, and counts as listed with the newest one."""
    body = b"page"
    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    listed = rows(spark, [("x", "1", "o", digest, "u1"), ("x", "1", "o", "2" * 32, "u1"), ("x", "1", "o", "-", "u1")])
    bodies = spark.createDataFrame([("x", "1", "o", "u1", body)], "label string, timestamp string, original string, archive_url string, body binary")
    assert [r["equal"] for r in captures.equals_latest(bodies, listed).collect()] == [digest > "2" * 32]


def test_latest_of_pages_that_share_an_address(spark, tmp_path):
    from inkspar.plans.sources import latest_equivalent

    pages = spark.createDataFrame([(i, "http://a.example.org/" if i < 9 else None, f"<p>{i % 4}") for i in range(12)], "page_id long, url string, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted(map(tuple, latest_equivalent(spark, str(tmp_path)).collect())) == [(i, i % 3 == 0) for i in range(12)]


def test_ranges_against_brute_force(spark):
    rng = random.Random(3)
    data = [(f, s, s + rng.randrange(1, 40)) for f in range(3) for s in (rng.randrange(2000) for _ in range(60))]
    df = spark.createDataFrame(data, "f int, a long, b long")
    for span in (60, 10_000):
        want = []
        for f in range(3):
            for a, b in sorted((a, b) for g, a, b in data if g == f):
                if want and want[-1][0] == f and a - want[-1][2] <= 10 and b - want[-1][1] <= span:
                    want[-1][2], want[-1][3] = max(want[-1][2], b), want[-1][3] + 1
                else:
                    want.append([f, a, b, 1])
        got = sorted(list(r) for r in captures.coalesce_ranges(df, "f", "a", "b", 10, span).collect())
        assert got == sorted(want)


def test_json_index(spark):
    index = [["timestamp", "original", "mimetype", "digest"], ["20150101000000", "http://pages.example.org/view.php?t=a", "text/html", "-"], ["20150101000000", "http://pages.example.org/view.php?t=b", "image/png", "-"], ["20150101000000", "http://pages.example.org/other?t=b", "text/html", "-"], [], ["next"]]
    page = lambda x: spark.createDataFrame([(json.dumps(x),)], "body string")
    assert [r["label"] for r in cdx.json_captures(page(index), SCOPE).collect()] == ["a"]
    assert cdx.json_rows(page(index)).first()["resume_key"] == "next" and cdx.json_captures(page([]), SCOPE).count() == 0
    for bad in (index + [["again"]], [["a", "b"]], index[:1] + [["x", "y"]], index[:1] + [["2015", "http://pages.example.org/view.php?t=a", "text/html", "-"]]):
        with pytest.raises(Exception):
            cdx.json_captures(page(bad), SCOPE).collect()


def test_line_index(spark, tmp_path):
    line = "k 20150225000000 http://pages.example.org/view.php?t={} text/html {} {} - - {} 7 c.warc.gz"
    good = [line.format("a", 200, "A" * 32, 100), line.format("a", 200, "A" * 32, 101), line.format("b", 404, "A" * 32, 100)]
    path = str(tmp_path / "i.gz")
    with gzip.open(path, "wt") as f:
        f.write("\n".join([" " + cdx.HEADER, *good]) + "\n")
    found = cdx.line_captures(cdx.lines(spark, path), SCOPE, "20150224000000", "20150302235959", "c.warc.gz").collect()
    assert [(r["label"], r["warc_length"], r["warc_offset"]) for r in found] == [("a", 100, 7)]
    with gzip.open(path, "wt") as f:
        f.write("\n".join([" " + cdx.HEADER, line.format("a", 200, "a" * 32, 100)]) + "\n")
    with pytest.raises(Exception):
        cdx.line_captures(cdx.lines(spark, path), SCOPE, "20150224000000", "20150302235959", "c.warc.gz").collect()


def make_member(page=b"<p>x</p>", uri="http://pages.example.org/view.php?t=a", status="200 OK", extra=""):
    block = f"HTTP/1.1 {status}\r\nContent-Length: {len(page)}\r\n{extra}\r\n".encode() + page
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {uri}\r\nWARC-Date: 2015-02-25T00:00:00Z\r\nContent-Length: {len(block)}\r\nWARC-Block-Digest: sha1:{member.sha1(block)}\r\nWARC-Payload-Digest: sha1:{member.sha1(page)}\r\n\r\n".encode()
    return gzip.compress(head + block + b"\r\n\r\n"), page


def test_member(spark):
    packed, page = make_member()
    line = (len(packed), "http://pages.example.org/view.php?t=a", "20150225000000", member.sha1(page))
    assert member.body(packed, *line) == page
    for i, other in ((0, 1), (1, "x"), (2, "20150225000001"), (3, "A" * 32)):
        with pytest.raises(ValueError):
            member.body(packed, *[other if j == i else v for j, v in enumerate(line)])
    for bad in (make_member(status="404 Not")[0], make_member(extra="Content-Encoding: gzip\r\n")[0], packed[:-9], b"x"):
        with pytest.raises(ValueError):
            member.body(bad, len(bad), *line[1:])
    got = spark.createDataFrame([(packed, *line), (b"x", *line), (None, *line)], "c binary, n long, o string, t string, d string").select(member.bodies(*map(F.col, "cnotd")).alias("r")).collect()
    assert [(r["r"]["body"] is not None, r["r"]["error"] is None) for r in got] == [(True, True), (False, False), (False, False)]


def test_earlier_and_pacing(spark):
    listed = rows(spark, [("x", "2", "o", "D", "u"), ("x", "1", "p", "E", "v")])
    records = spark.createDataFrame([("x", "1", "p", "E", "2", "why"), ("x", "2", "o", "D", "2", "why"), ("x", "1", "p", "E", "3", "why"), ("x", "1", "z", "E", "2", "why"), ("x", "1", "p", "E", "2", " "), ("n", "1", "p", "E", "2", "why")], "label string, timestamp string, original string, digest string, latest_indexed_timestamp string, selection_reason string")
    assert sorted(str(r["problem"]) for r in captures.earlier_revisions(records, listed).collect()) == ["None", "latest differs", "no reason", "not earlier", "not indexed", "unknown label"]
    starts = [r["start"] for r in pacing.schedule(spark.createDataFrame([(1, i, 0.5) for i in range(5)], "u int, n int, took double"), "u", "n", "took", 1.5, 2, 15.0).orderBy("n").collect()]
    assert starts == [0.0, 1.5, 17.0, 18.5, 34.0]
    for bad in ((-1, 2, 1), (1, 0, 1), (1, 2, float("inf"))):
        with pytest.raises(ValueError):
            pacing.schedule(listed, "label", "timestamp", "digest", *bad)
    got = spark.createDataFrame([("10",), ("900",), ("x",), (None,), ("Wed, 25 Feb 2015 00:10:00 GMT",)], "h string").select(pacing.backoff_wait(F.col("h"), F.lit("2015-02-25 00:00:00").cast("timestamp"))).collect()
    assert [r[0] for r in got] == [300, 900, 300, 300, 600]


@pytest.mark.parametrize("pieces", [1, 3, 40])
def test_islands_of_one_file_over_many_pieces(spark, pieces):
    """Nearly all rows are of one file, and some reach over many others; a null file is a file."""
    rng = random.Random(pieces)
    data = [(rng.choice([1] * 20 + [2, None]), s, s + rng.choice([1, 5, 30, 900])) for s in (rng.randrange(9000) for _ in range(500))] + [(1, 20_000, 20_001)]
    want = []
    for f in (1, 2, None):
        for a, b in sorted((a, b) for g, a, b in data if g == f):
            if want and want[-1][0] == f and a - want[-1][2] <= 10:
                want[-1][2], want[-1][3] = max(want[-1][2], b), want[-1][3] + 1
            else:
                want.append([f, a, b, 1])
    df = spark.createDataFrame(data, "f int, a long, b long")
    got = captures.coalesce_gaps(df, "f", "a", "b", 10, pieces)
    assert sorted(map(str, (list(r) for r in got.collect()))) == sorted(map(str, want)) and got.columns == ["f", "group_start", "group_end", "members"]
    assert captures.coalesce_gaps(df.limit(0), "f", "a", "b").count() == 0


def test_passages_of_any_length(spark):
    from inkspar.operators.passages import containing

    rng = random.Random(1)
    word = lambda: rng.choice(["ab", "a", "b", "ba", "é"])
    texts = [" ".join(word() for _ in range(rng.randrange(12))).replace(" ", rng.choice([" ", "  ", "\n"])) for _ in range(60)] + [None, ""]
    asked = [" ".join(word() for _ in range(n)) for n in (1, 1, 2, 2, 3, 3, 4, 5, 6)] + [None, "a \n b"]
    docs, items = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(asked)), "item_id long, passage string")
    flat = lambda t: " ".join(t.split())
    want = {(i, j) for i, t in enumerate(texts) for j, p in enumerate(asked) if t is not None and p is not None and flat(p) in flat(t)}
    got = containing(docs, items)
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want) and {j for _, j in want} >= {4, 5}
    assert containing(docs, items.limit(0)).count() == 0 and containing(docs.limit(0), items).count() == 0


def test_licence_names_in_columns_as_in_text(spark):
    from inkspar.functions import licences

    rng = random.Random(2)
    parts = ["cc", "CC.", "creative", "commons", "by", "by.", "sa", "2.0", "3.0.", "nc", "x1", ".", "xcc", "écc", ".cc", "-", ",", "all", "rights", "reserved", "Reserved!", "non", "commercial", "noncommercial", "no", "copying", "(", "日"]
    texts = ["".join(rng.choice(parts) + rng.choice([" ", " ", "  ", "-", "\n", ""]) for _ in range(rng.randrange(1, 14))) for _ in range(3000)] + ["cc by " + "word " * 20_000 + "2.0", "", "CC BY-SA 2.0"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", licences.names_in(F.col("t")).alias("n"), licences.restricts(F.col("t")).alias("r"), licences.conflicts(F.col("t")).alias("c")).collect()
    assert all((r["n"], r["r"], r["c"]) == (licences.names_in_text(r["t"]), licences.restricts_in_text(r["t"]), licences.conflicts_in_text(r["t"])) for r in rows)
    assert sum(bool(r["n"]) for r in rows) > 8 and sum(r["r"] for r in rows) > 20
