import hashlib
import json
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkspar.functions.urls import Scope
from inkspar.operators import normalize, omissions
from inkspar.sources import feed, legacy_pages, pages, sinks

SITE = pages.Site("example", "site.example.org", "/g/")
FOOT = '<div class="GrammarPartSeparateDiv"><span>x</span><span style="float:right">#3 Ann</span></div>'
ENTRY = f"""<html><body><div id="editable_Main_7"><div class="GrammarPartMainDiv"><div><a>Title </a><span>label</span></div>JLPT N4<div class="GrammarPartJapDiv">form</div>{FOOT.replace("Div", "MainDiv")}</div></div>
<div id="editable_Meaning_1"><div class="GrammarPartDiv"><div><span>first</span></div></div></div>
<div id="editable_Meaning_2"><div class="GrammarPartDiv"><div><span>means</span><span>ex</span><span lang="fr">note</span></div>{FOOT}</div></div>
<div id="editable_Formation_3"><div class="GrammarPartDiv"><div><div lang="ja">A <b>B</b></div></div></div></div><div id="editable_Formation_0"></div>
<div id="editable_Comment_0"><div class="GrammarPartDiv"><div>Write a comment ></div></div></div>
<div id="editable_Story_4"><div class="GrammarPartDiv"><div>story</div></div></div>
<div id="editable_Phrase_0"></div><div id="editable_Phrase_9"><div class="GrammarPartDiv"><div lang="ja">ja<span style="color:#00b060">hi</span></div><div>read</div><div><img src="/flags/en.png"><span>said</span></div>{FOOT}</div></div>
<div id="GrammarCommentsDiv"><div class="GrammarPartDiv"><div>c1<br>c2</div><div>Bob</div></div><div class="GrammarPartDiv"><div>alone</div></div></div>
<div class="GrammarPartDiv" id="q">stray</div><a href="/g/8/">eight</a><a href="/g/8/?x=1">no</a><a href="https://other.example.org/g/9">no</a></body></html>"""


def test_entry():
    r = pages.entry(ENTRY, 7, SITE, "now")
    assert (r["title"], r["romanized_label"], r["alternate_forms"], r["jlpt_level"], r["credits_raw"]) == ("Title", "label", ["form"], 4, "Ann")
    assert (r["meaning"], r["meaning_example"], [n["language"] for n in r["meaning_notes"]], r["formations"]) == ("means", "ex", ["fr"], ["A B"])
    assert [s["kind"] for s in r["sections"]] == ["meaning", "meaning", "formation", "story", "unclassified"] and len(r["warnings"]) == 2
    (x,) = r["examples"]
    assert (x["source_id"], x["position"], x["japanese"], x["reading"], x["credits_raw"]) == (9, 1, "jahi", "read", "Ann")
    assert x["segments"][1] == {"text": "hi", "grammar_highlight": True} and x["translations"][0]["language"] == "en"
    assert [c["credits_raw"] for c in r["comments"]] == ["Bob", None] and r["comments"][1]["content_sha256"] == hashlib.sha256(b"None\0alone").hexdigest()
    assert [e["target_id"] for e in r["related_entries"]] == [8]


@pytest.mark.parametrize(("old", "new"), [("editable_Main_7", "editable_Main_8"), ("Title ", ""), ("editable_Story_4", "editable_Story"), ("editable_Phrase_0", "editable_Phrase_9"), ("<div>read</div>", "<div>read</div><div>again</div>"), ("<div>Bob</div>", "<div>a</div><div>b</div>")])
def test_changed_layout_is_refused(old, new):
    with pytest.raises(ValueError):
        pages.entry(ENTRY.replace(old, new), 7, SITE, "now")


def test_index(spark):
    row = '<div class="GrammarSummaryDiv"><input id="GrammarEntryId1" value="5"><div>t</div><div>m</div><div>e</div><div></div></div>'
    page = f'<div id="GrammarContent">{row}<a class="PageLink" href="?page=2">2</a><a class="PageLink" href="?page=1">1</a></div>'
    found = pages.index_rows(page, SITE.base + SITE.path, SITE)
    assert found["rows"] == [{"id": 5, "source_url": "https://site.example.org/g/5/", "title": "t", "meaning": "m", "meaning_example": "e"}] and [n["page"] for n in found["next"]] == [2]
    for bad in (page.replace("?page=2", "/other/?page=2"), page.replace('value="5"', 'value="x"'), page.replace("GrammarContent", "x"), page.replace("?page=2", "?page=2&z=1")):
        with pytest.raises(ValueError):
            pages.index_rows(bad, SITE.base + SITE.path, SITE)
    df = spark.createDataFrame([(ENTRY, 7, "now"), ("<p>", 7, "now")], "h string, i long, t string").select(pages.entry_column(F.col("h"), F.col("i"), F.col("t"), SITE).alias("r"))
    assert [bool(r["r"]["error"]) for r in df.collect()] == [False, True]


def test_only_fields_that_are_asked_for_are_made(spark, monkeypatch):
    """They are those of the whole record, and a page is refused whatever is asked for, by the same fault."""
    whole = pages.entry(ENTRY, 7, SITE, "now")
    schema = StructType.fromDDL("title string, comments array<struct<text: string>>, sections array<struct<kind: string, credits_raw: string>>, examples array<struct<japanese: string, translations: array<struct<language: string>>>>")
    fields = pages.asked(schema)
    assert fields["examples"] == {"japanese", "translations"} and fields["examples.translations"] == {"language"}
    wanted = {
        "title": "Title", "sections": [{k: s[k] for k in ("kind", "credits_raw")} for s in whole["sections"]], "examples": [{"japanese": "jahi", "translations": [{"language": "en"}]}],
        "comments": [{"text": c["text"]} for c in whole["comments"]],
    }
    bad = [ENTRY.replace(*change) for change in [("Title ", ""), ("editable_Story_4", "editable_Story"), ("editable_Phrase_0", "editable_Phrase_9"), ("<div>Bob</div>", "<div>a</div><div>b</div>"), ("<div>story</div>", '<div><a href="http://[x/">s</a></div><div id="editable_Phrase_9">')]]
    asked = pages.entry_column(F.col("h"), F.lit(7), F.lit("now"), SITE, schema).alias("r")
    made, *refused = (row["r"] for row in spark.createDataFrame([(h,) for h in (ENTRY, *bad)], "h string").coalesce(1).select(asked).collect())
    assert json.loads(made["record_json"]) == wanted
    for page, row in zip(bad, refused, strict=True):
        with pytest.raises(ValueError) as fault:
            pages.entry(page, 7, SITE, "now")
        assert (row["record_json"], row["error"]) == (None, str(fault.value))

    def unasked(*_):
        raise AssertionError("made without being asked for")

    for name in ("fragment", "segments", "date_marks"):
        monkeypatch.setattr(pages, name, unasked)
    assert pages.entry(ENTRY, 7, SITE, "now", fields=fields) == wanted


@pytest.mark.parametrize("name", ["extract_comments", "extract_examples", "extract_sections", "audit_entry_content", "audit_current", "extract_relations"])
def test_a_query_asks_for_the_fields_that_it_reads(spark, name, tmp_path, monkeypatch):
    import __spark_entry__ as entry

    spark.range(3).selectExpr("id AS p_partkey", "'n' AS p_name", "'b' AS p_brand", "'t' AS p_type", "1 AS p_size").write.parquet(f"{tmp_path}/part.parquet")
    asked, column = [], pages.entry_column
    monkeypatch.setattr(pages, "entry_column", lambda *a: asked.append(a[-1].names) or column(*a))
    assert entry.queries()[name](spark, str(tmp_path)).count() == (2 if name == "extract_examples" else 3)
    wanted = {"extract_comments": ["comments"], "extract_sections": ["sections"], "audit_current": ["title", "meaning", "jlpt_level"], "extract_relations": ["related_entries"]}
    assert asked == [wanted.get(name, ["examples"])]


@pytest.mark.parametrize("name", ["scan_entry_html", "extract_sections", "unmapped_text", "unclassified_cards", "html_fragment", "sink_markdown", "split_multi_entry", "header_section", "scan_record_yaml"])
def test_rows_of_one_small_file_are_dealt_out_before_python(spark, name, tmp_path):
    """Each row is parsed once, behind a shuffle into as many tasks as the rows ask for: one file of a few MB would be one task."""
    import __spark_entry__ as entry

    spark.range(11_000).selectExpr("id AS p_partkey", "'n' AS p_name", "'b' AS p_brand", "'t' AS p_type", "1 AS p_size").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    spark.range(9_000).selectExpr("id AS s_suppkey", "'n' AS s_name", "1L AS s_nationkey").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(110_000).selectExpr("id AS event_id").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    plan = entry.queries()[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    nodes = re.findall(r"(ArrowEvalPython|Exchange hashpartitioning\(\w+#\d+L, \d+\), REPARTITION_BY_NUM|FileScan)", plan)
    python = [i for i, n in enumerate(nodes) if n == "ArrowEvalPython"]
    assert len(python) == (2 if name in ("split_multi_entry", "sink_markdown") else 1)
    assert all(any(n.startswith("Exchange") for n in nodes[i : nodes.index("FileScan", i)]) for i in python)
    assert not re.search(r"hashpartitioning\(\w+#\d+L, 1\), REPARTITION_BY_NUM", plan)


LICENCE = '<a href="https://creativecommons.org/licenses/by-sa/2.0/">l</a>'


def legacy(label="te", number=978, category="grammar"):
    return f"""<table><tr><td><span class="viewOnetitle">name [yomi] ({label})</span> <b>Category</b> <i>{category}</i><br><b>JLPT Level</b>: 0<br><b>Meaning</b>: means<br><b>Author</b> <i>Ann</i><a href="addGrammar.php?id={number}">edit</a></td></tr>
<tr><td><table><tr><td class="titleSection">Notes:</td></tr><tr><td class="bottom">note</td><td><a href="contributions.php?u=1">Bob</a></td></tr></table>
<table><tr><td class="titleSection">Examples:</td></tr><tr><td class="bottom red-bottom"><a name="12">ex #12</a></td><td>said <a href="http://WWWJDIC/x">spoken</a></td><td><a href="contributions.php">C</a></td></tr></table>
<table><tr><td class="titleSection">Comments:</td></tr><tr><td>D</td><td class="bottom">hello</td><td></td></tr></table>
<div><span class="titleSection">See Also:</span><ul><li><a href="viewOne.php?tagE=a">a</a> one<li><a href="viewOne.php?tagE=b">b</a> two <a href="contributions.php">E</a></ul></div></td></tr></table>"""


CAPTURE = {"original": "http://old.example.org/pages/viewOne.php?tagE=te", "label": "te", "timestamp": "20150225000000", "digest": "-", "archive_url": "x"}


def test_legacy_page():
    r = legacy_pages.page((legacy() + LICENCE).encode(), CAPTURE)
    assert (r["title"], r["reading"], r["romanized_label"], r["id"], r["jlpt_level_original"], r["meaning"], r["credits_raw"]) == ("name", "yomi", "te", 978, "0", "means", "Ann")
    assert [(n["text"], n["credits_raw"]) for n in r["notes"]] == [("note", "Bob")] and [(c["credits_raw"], c["text"]) for c in r["comments"]] == [("D", "hello")]
    assert [(e["source_id"], e["japanese"], e["credits_raw"], e["verification_class"]) for e in r["examples"]] == [(12, "spoken", "C", ["bottom", "red-bottom"])]
    assert [(x["target_label"], x["annotation_text"], x["credits_raw"]) for x in r["related_entries"]] == [("a", "a one", None), ("b", "b two E", "E")]
    assert "edit" not in r["sections"][0]["html"] and r["warnings"] == []


def test_several_entries_and_gates():
    two = legacy() + legacy("ni", 1649)
    r = legacy_pages.page((two + LICENCE).encode(), CAPTURE)
    assert r["id"] == 978 and [(e["id"], e["page_entry_position"], len(e["notes"])) for e in r["additional_entries"]] == [(1649, 1, 1)] and len(r["notes"]) == 1
    body = lambda html: (html + LICENCE).encode()
    rules = legacy_pages.Rules(frozenset({978}))
    assert legacy_pages.page(body(legacy(category="flash")), CAPTURE, rules)["category"] == "flash"
    with pytest.raises(legacy_pages.Outside):
        legacy_pages.page(body(legacy(category="flash")), CAPTURE)
    for held in (body(legacy() + legacy()), body(legacy().replace("<b>Category</b> <i>grammar</i>", "")), legacy().encode(), body(legacy() + '<a href="https://creativecommons.org/licenses/by-nc/2.0/">l</a>'), body(two.replace("<i>grammar</i>", "<i>flash</i>", 1))):
        with pytest.raises(legacy_pages.Held):
            legacy_pages.page(held, CAPTURE)
    with pytest.raises(legacy_pages.Held):
        legacy_pages.page(body(legacy(category="flash")), CAPTURE | {"digest": "A" * 32})
    with pytest.raises(legacy_pages.Outside):
        legacy_pages.page(b"No entry exists for te - <a href='addGrammar.php'>click here</a> to add one" + LICENCE.encode(), CAPTURE)
    with pytest.raises(ValueError):
        legacy_pages.page(b"No entry exists for no - click here to add one" + LICENCE.encode(), CAPTURE)
    rules = legacy_pages.Rules(reviews={(978, "te"): {"decision": "grammar", "category": None, "expected_title": "name [yomi] (te)"}})
    assert legacy_pages.page(body(legacy().replace("<b>Category</b> <i>grammar</i>", "")), CAPTURE, rules)["membership_review"]["decision"] == "grammar"


def test_reviewed_omission():
    cell = '<div><span class="titleSection">Tutorial:</span> long text</div>'
    body = (legacy() + cell + LICENCE).encode()
    at = body.index(cell.encode())
    sha = lambda b: hashlib.sha256(b).hexdigest()
    review = {"response_sha256": sha(body), "source_url": CAPTURE["original"], "label": "te", "section": "Tutorial", "id": 978, "byte_offset": at, "byte_length": len(cell), "range_sha256": sha(cell.encode()), "text_sha256": sha(b"Tutorial: long text")}
    assert [s["kind"] for s in legacy_pages.page(body, CAPTURE)["sections"]] == ["header", "Tutorial"]
    r = legacy_pages.page(body, CAPTURE, legacy_pages.Rules(omissions=(review,)))
    assert [s["kind"] for s in r["sections"]] == ["header"] and r["source_sections_complete"] is False and len(r["comments"]) == 1 and r["omitted_sections"] == [review]
    for key, other in (("section", "Other"), ("id", 1), ("byte_length", 3), ("byte_offset", len(body)), ("text_sha256", "x")):
        with pytest.raises(ValueError):
            legacy_pages.page(body, CAPTURE, legacy_pages.Rules(omissions=(review | {key: other},)))
    repairs = [{"byte_offset": a, "byte_length": 5} for a in (0, at + 1)]
    assert legacy_pages.kept_repairs(repairs, [review]) == repairs[:1]
    with pytest.raises(legacy_pages.Held):
        legacy_pages.kept_repairs([{"byte_offset": at - 2, "byte_length": 5}], [review])


SCOPE = Scope(hosts=("old.example.org",), page_path="/pages/viewOne.php", label_field="tagE", feed_paths=("/rss/n1.xml",))


def test_feed():
    item = "<item><title>{0}</title><link>http://old.example.org/pages/viewOne.php?tagE={0}</link><description>&lt;b&gt;x&lt;/b&gt;&lt;a href='/pages/addEx.php'&gt;add&lt;/a&gt;{1}</description></item>"
    xml = "<rss><channel><title>T</title>{}" + item.format("te", "") + item.format("no", "") + item.format("ni", "&lt;a href='https://creativecommons.org/licenses/by-nc/2.0/'&gt;l&lt;/a&gt;") + "</channel></rss>"
    original = "http://old.example.org/rss/n1.xml"
    capture = {"archive_url": SCOPE.archive_url("20150225000000", original), "timestamp": "20150225000000", "original": original}
    r = feed.feed(xml.format("").encode(), capture, "now", {"te": 1, "ni": 2}, SCOPE)
    assert [(i["label"], i["entry_id"], i["body_html"]) for i in r["items"]] == [("te", 1, "<b>x</b>")] and "add" in r["items"][0]["description_raw_html"]
    assert [x["position"] for x in r["review_required"]] == [1, 2]
    for text, bad in (("CC BY-SA 2.0", False), ("Creative Commons - BY - SA - 2.0", False), ("CC-BY-NC 2.0", True), ("All rights  reserved", True), ("https://creativecommons.org/licenses/by-sa/2.0/", False), ("https://creativecommons.org/licenses/by/2.0/", True)):
        got = feed.feed(xml.format(f"<copyright>{text}</copyright>").encode(), capture, "now", {"te": 1}, SCOPE)["review_required"]
        assert any(x["position"] is None for x in got) == bad, text
    for broken in (b"<rss>", b"<x/>", b"<rss/>"):
        with pytest.raises(ValueError):
            feed.feed(broken, capture, "now", {}, SCOPE)
    with pytest.raises(ValueError):
        feed.feed(xml.format("").encode(), capture | {"timestamp": "20150225000001"}, "now", {}, SCOPE)


def test_relations_views_and_sinks(spark, tmp_path):
    record = pages.entry(ENTRY, 7, SITE, "now")
    record["warnings"] = []
    schema = spark.read.json(spark.sparkContext.parallelize([json.dumps(record)])).schema
    df = spark.read.schema(schema).json(spark.sparkContext.parallelize([json.dumps(record)]))
    found = normalize.relations(df)
    assert {k: v.count() for k, v in found.items()} == {"entries": 1, "entry_forms": 1, "meaning_notes": 1, "sections": 5, "formations": 1, "examples": 1, "translations": 1, "comments": 2, "related_entries": 1}
    view = normalize.search_view(found)
    assert view.groupBy("kind").count().count() == 5 and view.count() == 1 + 5 + 1 + 1 + 2
    assert view.filter("kind = 'entry'").first()["text"] == "Title\nmeans\nex"
    counts = sinks.write_sqlite(found, str(tmp_path / "x.db"), views={"v": "SELECT id FROM entries"})
    assert counts["sections"] == 5
    with pytest.raises(FileExistsError):
        sinks.write_sqlite(found, str(tmp_path / "x.db"))
    bad = [("none", spark.range(0)), ("orphans", normalize.orphans(found["comments"], ["entry_id"], spark.range(0), ["id"]))]
    with pytest.raises(ValueError, match="orphans: 2 rows"):
        sinks.write_relations(found, str(tmp_path / "r"), bad)
    assert not (tmp_path / "r").exists()
    sinks.write_relations(found, str(tmp_path / "r"), bad[:1])
    assert spark.read.parquet(str(tmp_path / "r/comments")).count() == 2
    page = spark.createDataFrame([(json.dumps(record),)], "j string").select(sinks.rendered(F.col("j")).alias("p")).first()["p"]
    assert page["path"] == "n4/7.md" and "# Title" in page["body"]


def test_managed_pages(tmp_path):
    root = str(tmp_path / "m")
    assert sinks.update_pages({"n1/1.md": "a", "README.md": "r"}, root)["updated"] == ["README.md", "n1/1.md"]
    before = (tmp_path / "m/n1/1.md").stat().st_mtime_ns
    assert sinks.update_pages({"n1/1.md": "a", "n2/2.md": "b"}, root) == {"updated": ["n2/2.md"], "removed": ["README.md"], "unchanged": ["n1/1.md"]}
    assert (tmp_path / "m/n1/1.md").stat().st_mtime_ns == before and not (tmp_path / "m/README.md").exists()
    (tmp_path / "m/n1/1.md").write_text("edited")
    with pytest.raises(ValueError):
        sinks.update_pages({"n2/2.md": "c"}, root)
    assert (tmp_path / "m/n2/2.md").read_text() == "b"
    for name in ("../x.md", "n9/1.md", "n1/01.md", "archive/1-x.md"):
        with pytest.raises(ValueError):
            sinks.update_pages({name: "x"}, str(tmp_path / "n"))


def test_bundle(tmp_path):
    from inkspar.sources import bundle

    rule = (("current",), ("entries",), ("inventory.json",))
    for name in ("current/entries/1.yaml", "current/entries/a/2.yaml", "current/inventory.json", "current/other/x", "current/entries/.hidden"):
        path = tmp_path / "d" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(name)
    out = str(tmp_path / "b.tar.gz")
    manifest = bundle.backup(str(tmp_path / "d"), out, *rule)
    assert [m["path"] for m in manifest] == ["current/entries/1.yaml", "current/entries/a/2.yaml", "current/inventory.json"]
    bundle.restore(out, str(tmp_path / "r"), *rule)
    assert (tmp_path / "r/current/entries/a/2.yaml").read_text() == "current/entries/a/2.yaml"
    with pytest.raises(FileExistsError):
        bundle.restore(out, str(tmp_path / "r"), *rule)
    with pytest.raises(ValueError):
        bundle.restore(out, str(tmp_path / "s"), ("current",), ("entries",), ())
    assert not (tmp_path / "s").exists()


def test_omissions(spark):
    text = "a" * 300 + " " + "b" * 800
    sha = lambda a, n: hashlib.sha256(text[a : a + n].encode()).hexdigest()
    rows = [([(0, 300, sha(0, 300)), (301, 800, sha(301, 800))],), ([(301, 800, sha(301, 800)), (0, 300, sha(0, 300))],), ([(0, 300, sha(0, 300))],), ([(0, 300, sha(0, 299)), (301, 800, sha(301, 800))],)]
    df = spark.createDataFrame(rows, "p array<struct<offset: int, length: int, sha256: string>>")
    assert [r[0] for r in df.select(omissions.passages_hold(F.lit(text), F.col("p"))).collect()] == [True, False, False, False]
    repairs = spark.createDataFrame([([(5, 5), (20, 5), (98, 5)],)], "r array<struct<byte_offset: int, byte_length: int>>")
    assert repairs.select(F.size(omissions.outside(F.col("r"), F.lit(10), F.lit(100))), omissions.crossing(F.col("r"), F.lit(10), F.lit(100)), omissions.crossing(F.col("r"), F.lit(10), F.lit(50))).first()[:] == (1, True, False)


def test_streaming(spark, tmp_path, sf_dir):
    from inkspar.streaming import captures

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    source = str(tmp_path / "in")
    events.select(F.col("user_id").cast("string").alias("label"), F.date_format("ts", "yyyyMMddHHmmss").alias("timestamp"), F.col("event_id").cast("string").alias("original")).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    query = captures.newest_by_label(stream).writeStream.outputMode("complete").format("memory").queryName("newest").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(map(tuple, spark.sql("SELECT * FROM newest").collect())) == sorted(map(tuple, captures.newest_by_label(spark.read.parquet(source)).collect()))


def test_refused_pages_have_no_markdown(spark, tmp_path):
    """A page without a title is refused; it ends no job, and its row has neither a path nor a text. Signs of markup stay behind a backslash."""
    import __spark_entry__ as entry

    spark.createDataFrame([(5, "n", "b", "t", 1), (6, " ", "b", "t", 1)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    found = entry.queries()["sink_markdown"](spark, str(tmp_path)).orderBy("p_partkey").collect()
    assert [(r["p_partkey"], r["path"], r["managed"], r["body_sha256"] is None) for r in found] == [(5, "n1/5.md", True, False), (6, None, False, True)]
    assert sinks.render({"title": "a\r#[b]\\_"}).startswith("# a\\#\\[b\\]\\\\\\_\n")
