import gc
import random
import time

import pytest

from inkspar.functions import html, legacy
from inkspar.sources import pages

BASE = "https://www.example.org/x/"


def test_tree_and_text():
    root = html.parse("<p>a<br>b<!-- c --><script>d</script><li>e<li>f</ul>g&amp;h</p> 　")
    assert html.text(root) == "a\nbefg&h"
    assert html.text(None) == ""
    li = next(n for n in root.walk() if n.tag == "li")
    assert [n.tag for n in li.walk()] == ["li"]


def test_references_without_a_semicolon(spark, tmp_path):
    """Titles that were cut within a reference, as in larger tables."""
    from inkspar.plans import pages

    page = "<title>a &amp;&amp</title><style>p&q{}</style><h1>b &copy; &copy</h1>c &am</p> d&<b>e</b> &amp;lt; &#65; &#65 f"
    spark.createDataFrame([(1, page)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(1, "n", "b")], "p_partkey long, p_name string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    shown = "a &&ampb © &copyc &am d&e &lt; A &#65 f"
    assert [r["body_text"] for r in pages.html_text(spark, str(tmp_path)).collect()] == [shown]
    assert shown in [r["text"] for r in pages.html_segments(spark, str(tmp_path)).collect()]
    assert html.text(html.parse("a &amp</p>b")) == "a &b"


def test_plain_pages_have_the_librarys_tree():
    """Pages of random pieces: where the short way is taken, its tree is that of the library's parser."""
    pieces = ["<p>", "</p>", '<b class="x y">', "</b>", "<br>", "a", "&amp;", "&copy", "&", " ;", "<", ">", '<a href="/x?a=1" id="q">', "</a>", '<a href="/?a=1&b=2">', "</ul>", "<script>", "</script>", "<P>", "<!-- c -->", "<p/>", "<title>", '<p  a="1" a="2">', "<p a=1>", '<q a="1"b="2">', "<noscript>"]
    shape = lambda n: (n.tag, list(n.attrs.items()), [c if isinstance(c, str) else shape(c) for c in n.children])
    draw, short = random.Random(5), 0
    for _ in range(5_000):
        page = "".join(draw.choices(pieces, k=draw.randint(0, 7)))
        whole = html._Builder()
        whole.feed(page)
        whole.close()
        plain = html._plain(page)
        short += plain is not None
        assert plain is None or shape(plain) == shape(whole.root), page
    assert short > 1_000


def test_fragment():
    made = html.fragment(html.parse('<div class=x><span style="font-weight: bold">a</span><font color=RED>b</font><font>c</font><img src=i><a href="/y?a=1&b=2" onclick=z>d</a><a href="javascript:1">e</a><form>f</form>&lt;g</div>'), BASE)
    assert made == '<div><strong>a</strong><strong>b</strong>c<a href="https://www.example.org/y?a=1&amp;b=2">d</a><a>e</a>&lt;g</div>'


def test_segments():
    root = html.parse('x <span style="color:#00B060">y<b>z</b></span><br>w<style>q</style>')
    assert html.segments(root) == [{"text": "x ", "grammar_highlight": False}, {"text": "yz", "grammar_highlight": True}, {"text": "\nw", "grammar_highlight": False}]


def test_labelled_value_and_credit():
    root = html.parse("<b>Level</b>: 3 <i>x</i><br>no<b>Author </b> by <i>Ann</i>")
    assert html.labelled_value(root, "Level") == "3 x" and html.labelled_value(root, "Author", italic=True) == "Ann" and html.labelled_value(root, "None") is None
    card = next(html.parse('<div id=c><div>a</div><div class="foot"><span>l</span><span style="float: right">#12 Bob</span></div></div>').walk())
    assert html.credit(card, ("foot",)) == "Bob" and html.credit(card, ("other",)) is None


def test_legacy_encodings():
    head = b"<meta charset=shift_jis>"
    assert legacy.decode("é".encode()) == ("é", "utf-8", [])
    assert legacy.decode(head + "日本".encode("shift_jis"))[1:] == ("shift_jis", [])
    assert legacy.decode(head + "①".encode("cp932"))[1:] == ("cp932", [])
    text, encoding, repairs = legacy.decode(head + "①".encode("cp932") + b"<p>" + "あ".encode() + b"</p>")
    assert text.endswith("<p>あ</p>") and [r["encoding"] for r in repairs] == ["utf-8"] and repairs[0]["byte_offset"] == 29
    text, _, repairs = legacy.decode(head + b'<a href="x?t=\x81\xff">')
    assert 'href="x?t=%81%FF"' in text and repairs[0]["original_bytes_hex"] == b"x?t=\x81\xff".hex()
    assert legacy.decode(head + b"\x81\xff<b>")[2][0]["encoding"] == "cp932-with-undecodable-bytes"


def test_trees_are_freed_without_the_collector():
    """Millions of pages are parsed in a worker: a tree goes with its page, and isn't left to Python's collector."""
    page = '<div id="editable_Main_1"><div class="GrammarPartMainDiv"><div><a>t</a><span>s</span></div></div></div>'
    site = pages.Site("example", "site.example.org", "/g/")
    gc.collect()
    gc.disable()
    try:
        assert pages.entry(page, 1, site, None)["title"] == "t"
        with pytest.raises(pages.Refused):
            pages.entry(page, 2, site, None)
        assert not [x for x in gc.get_objects() if isinstance(x, html.Node)]
    finally:
        gc.enable()


def test_tags_that_come_again_are_read_once():
    html._known_tag.cache_clear()
    tree = html.parse('<b class="x y">a</b>' * 100)
    assert html._known_tag.cache_info().misses == 2
    assert [n.classes() for n in tree.walk()] == [["x", "y"]] * 100
    html.parse(f'<b class="{"x" * 1_000}">a</b>')
    assert html._known_tag.cache_info().currsize == 2, "long tags aren't kept"


def test_trees_of_other_pages_are_freed_too():
    """A page that the short way gives up leaves nothing of the tree that was begun."""
    site = pages.Site("example", "site.example.org", "/g/")
    page = '<div id="editable_Main_1"><div class="GrammarPartMainDiv"><div><a>t</a></div></div></div><!-- c --><p a=1>'
    gc.collect()
    gc.disable()
    try:
        assert pages.entry(page, 1, site, None)["title"] == "t"
        assert not [x for x in gc.get_objects() if isinstance(x, html.Node)]
    finally:
        gc.enable()


def test_reading_takes_no_longer_by_depth_or_width():
    """Runs of text don't climb the elements around each of them, and a footer doesn't ask all its neighbours whether it is the last."""
    deep = html.parse('<b style="color:#00b060">x' * 10_000)
    wide = html.parse("<div>" + '<p class="foot"></p>' * 10_000 + "</div>")
    begun = time.process_time()
    assert html.segments(deep) == [{"text": "x" * 10_000, "grammar_highlight": True}]
    assert html.credit(wide, ("foot",)) is None
    assert time.process_time() - begun < 1


def test_marks_follow_the_page():
    """Marks come in the page's order, each with the blocks and comments around it, whichever way the page was parsed."""
    plain = '<div id="editable_A_1"><a href="/x"><div class="GrammarPartDiv"></div></a><div id="GrammarCommentsDiv"><div class="GrammarPartDiv y"></div></div></div><div class="GrammarPartJapDiv"></div>'
    shape = lambda marks: [(m.role, m.kind, m.number, [a.role for a in m.around], len(m.cards), len(m.forms)) for m in marks]
    wanted = [("block", "A", 1, [], 2, 0), ("link", "", -1, ["block"], 0, 0), ("card", "", -1, ["block"], 0, 0), ("comments", "", -1, ["block"], 1, 0), ("card", "", -1, ["block", "comments"], 0, 0), ("form", "", -1, [], 0, 0)]
    assert html._plain(plain) is not None and html._plain(plain + "<!-- c -->") is None
    for page in (plain, plain + "<!-- c -->", "<!-- c -->" + plain):
        assert shape(pages.outline(html.nodes(page))) == wanted


def test_addresses_that_come_again_are_read_once():
    site = pages.Site("example", "site.example.org", "/g/")
    page = '<div id="editable_Main_1"><div class="GrammarPartMainDiv"><div><a>t</a></div></div></div>' + '<a href="/g/5/">x</a><a href="/h/5/">y</a>' * 50
    pages._known_target.cache_clear()
    assert pages.entry(page, 1, site, None)["related_entries"] == [{"target_id": 5, "label": "x", "source_url": "https://site.example.org/g/5/"}] * 50
    assert pages._known_target.cache_info().misses == 2
