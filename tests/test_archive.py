import json

from inkspar import __main__ as cli
from inkspar import archive
from inkspar.sources import feed, legacy_pages, pages, records
from tests.test_pages import CAPTURE, ENTRY, LICENCE, SCOPE, SITE, legacy


def written(tmp_path):
    for i in (7, 8):
        entry = pages.entry(ENTRY.replace("editable_Main_7", f"editable_Main_{i}"), i, SITE, "now")
        entry["warnings"] = []
        records.write(str(tmp_path / f"current/{i}.yaml"), entry)
    old = legacy_pages.page((legacy() + legacy("ni", 1649) + LICENCE).encode(), CAPTURE)
    records.write(str(tmp_path / "archive/a.yaml"), old)
    original = "http://old.example.org/rss/n1.xml"
    xml = "<rss><channel><title>T</title><item><link>http://old.example.org/pages/viewOne.php?tagE=te</link></item></channel></rss>"
    made = feed.feed(xml.encode(), {"archive_url": SCOPE.archive_url("20150225000000", original), "timestamp": "20150225000000", "original": original}, "now", {"te": 7}, SCOPE)
    records.write(str(tmp_path / "feeds/f.yaml"), made)
    return ["--current", str(tmp_path / "current"), "--archive", str(tmp_path / "archive"), "--feeds", str(tmp_path / "feeds")]


def test_build_and_audit(spark, tmp_path, capsys):
    folders = written(tmp_path)
    assert cli.run(["build", str(tmp_path / "out"), "--sqlite", str(tmp_path / "x.db"), "--pages", str(tmp_path / "pages"), *folders]) == 0
    counts = json.loads(capsys.readouterr().out)
    assert counts["entries"] == 2 and counts["examples"] == 2 and counts["archive_entries"] == 2 and counts["archive_notes"] == 2 and counts["archive_relationships"] == 4 and counts["archive_feed_items"] == 1
    assert (tmp_path / "x.db").exists() and (tmp_path / "pages/n4/7.md").exists() and (tmp_path / "pages/README.md").exists()
    assert cli.run(["update-pages", "--pages", str(tmp_path / "pages"), *folders]) == 0
    assert json.loads(capsys.readouterr().out)["updated"] == 0
    assert cli.run(["audit", *folders]) == 0
    bad = json.loads(json.dumps(records.load((tmp_path / "current/7.yaml").read_bytes()))) | {"warnings": ["look"]}
    records.write(str(tmp_path / "current/7.yaml"), bad)
    assert cli.run(["audit", *folders]) == 1 and cli.run(["build", str(tmp_path / "again"), *folders]) == 2
    assert not (tmp_path / "again").exists()
    keys = [r["key"] for r in archive.observations(spark, str(tmp_path / "archive")).collect()]
    assert len(set(keys)) == 2


def test_commands_without_spark(tmp_path, capsys):
    (tmp_path / "d/current/entries").mkdir(parents=True)
    (tmp_path / "d/archive").mkdir()
    (tmp_path / "d/current/entries/1.json").write_text('{"id": 1}')
    assert cli.run(["migrate", str(tmp_path / "d/current")]) == 0
    assert cli.run(["backup", str(tmp_path / "d"), str(tmp_path / "b.tgz")]) == 0 and cli.run(["restore", str(tmp_path / "b.tgz"), str(tmp_path / "r")]) == 0
    assert (tmp_path / "r/current/entries/1.yaml").read_text() == "id: 1\n"
    assert cli.run(["restore", str(tmp_path / "b.tgz"), str(tmp_path / "r")]) == 2 and cli.run(["audit"]) == 2


def test_states_gate_an_export(spark, tmp_path):
    import pytest

    written(tmp_path)
    folder = str(tmp_path / "current")
    digests = {r["key"]: r["record_sha256"] for r in archive._judged(archive.current(spark, folder)).collect()}
    lines = lambda name, rows: (tmp_path / name).mkdir(exist_ok=True) or (tmp_path / name / "a.json").write_text("\n".join(map(json.dumps, rows))) and str(tmp_path / name)
    good = [{"key": k, "status": "parsed", "record_sha256": d} for k, d in digests.items()]
    assert [r["id"] for r in archive.read_records(spark, folder, True, lines("s", good)).collect()] == [7, 8]
    with pytest.raises(ValueError):
        archive.read_records(spark, folder, True)
    for states, holds in (([good[0]], []), ([good[0], good[1] | {"status": "failed"}], []), ([good[0], good[1] | {"record_sha256": "x"}], []), (good, [{"key": "8", "hold": "report"}])):
        with pytest.raises(ValueError, match="records held"):
            archive.read_records(spark, folder, True, lines("s", states), lines("h", holds) if holds else None)
    assert archive.audit(spark, current_folder=folder, states=lines("s", good))["export_ready"] and not archive.audit(spark, current_folder=folder, states=lines("s", good[:1]))["export_ready"]


def test_extract_and_audit_of_captures(spark, tmp_path, capsys):
    import hashlib

    page = (legacy() + LICENCE).encode()
    (tmp_path / "bodies").mkdir()
    (tmp_path / "bodies/x").write_bytes(page)
    capture = CAPTURE | {"retrieved_at": "now", "body_sha256": hashlib.sha256(page).hexdigest()}
    (tmp_path / "index").mkdir()
    (tmp_path / "index/a.json").write_text(json.dumps(capture) + "\n" + json.dumps(capture | {"timestamp": "20160101000000", "body_sha256": "gone"}))
    at = [str(tmp_path / "index"), str(tmp_path / "bodies")]
    assert cli.run(["extract", *at, str(tmp_path / "out"), str(tmp_path / "states")]) == 1
    assert json.loads(capsys.readouterr().out) == {"parsed": 1, "pending": 1}
    assert cli.run(["audit-captures", *at, str(tmp_path / "out")]) == 0
    assert json.loads(capsys.readouterr().out) == {"equal": 1}
    (stored,) = (tmp_path / "out").glob("*.yaml")
    records.write(str(stored), records.load(stored.read_bytes()) | {"title": "other"})
    assert cli.run(["audit-captures", *at, str(tmp_path / "out")]) == 1
    assert json.loads(capsys.readouterr().out) == {"record_sha256": 1}


def test_sqlite_keys(spark, tmp_path):
    import sqlite3

    import pytest

    from inkspar.sources import sinks

    tables = {"a": spark.range(3), "b": spark.createDataFrame([(1, 0), (2, 2)], "i long, a_id long")}
    rules = {"keys": {"a": ("id",), "b": ("i",)}, "references": {"b": [(("a_id",), "a", ("id",))]}}
    sinks.write_sqlite(tables, str(tmp_path / "x.db"), **rules)
    sql = sqlite3.connect(tmp_path / "x.db").execute("SELECT sql FROM sqlite_master WHERE name = 'b'").fetchone()[0]
    assert "PRIMARY KEY" in sql and "REFERENCES" in sql
    for bad in ({"b": spark.createDataFrame([(1, 7)], "i long, a_id long")}, {"a": spark.createDataFrame([(1,), (1,)], "id long")}):
        with pytest.raises((ValueError, sqlite3.IntegrityError)):
            sinks.write_sqlite(tables | bad, str(tmp_path / "y.db"), **rules)
        assert not (tmp_path / "y.db").exists()
    with pytest.raises(ValueError):
        sinks.write_sqlite(tables, str(tmp_path / "z.db"), most_rows=2)
