"""Relations to Parquet folders or one SQLite file; records to Markdown pages; updates of managed pages."""

from __future__ import annotations

import hashlib
import json
import os
import re
import sqlite3
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspar.operators.normalize import assert_none

MANIFEST = ".pages.json"
#: README, pages by level, unclassified pages, and pages of observations.
PAGE = r"(?:README\.md|(?:n[1-5]|unclassified)/[1-9]\d*\.md|archive/(?:(?:[1-9]\d*|unknown)-[a-f0-9]{12}|feed-[a-z0-9]+)\.md)"
#: Rows of a relation in one SQLite file at most.
SQLITE_ROWS = 50_000_000
SQLITE_TYPES = {"bigint": "INTEGER", "int": "INTEGER", "boolean": "INTEGER", "double": "REAL"}


def page_allowed(path: Column) -> Column:
    return F.coalesce(path.rlike(f"^{PAGE}$"), F.lit(False))


def write_relations(found: dict[str, DataFrame], folder: str, checks: Iterable[tuple[str, DataFrame]] = ()) -> None:
    """A Parquet folder for each relation, after all checks hold; an existing one is an error. No relation is written in place of another."""
    assert_none(list(checks)) if checks else None
    for name, df in found.items():
        df.write.mode("errorifexists").parquet(f"{folder.rstrip('/')}/{name}")


def write_sqlite(found: dict[str, DataFrame], path: str, schema_version: int = 3, views: dict[str, str] | None = None, checks: Iterable[tuple[str, DataFrame]] = (), keys: dict[str, tuple[str, ...]] | None = None, references: dict[str, list[tuple[tuple[str, ...], str, tuple[str, ...]]]] | None = None, most_rows: int = SQLITE_ROWS) -> dict[str, int]:
    """One new SQLite file for readers without Spark, with a metadata table and views; the counts of rows.

    keys names the primary key of a relation, references its foreign keys as (columns, parent, parent's columns); both
    are part of the tables made, and the file is refused if a row breaks one. A single file is written by one process:
    rows come to the driver partition by partition, never all at once, and a relation of more than most_rows is an
    error, for which write_relations is the way. The file appears only when it is complete and sound.
    """
    target = Path(path)
    if target.exists() or target.is_symlink():
        raise FileExistsError(path)
    checks = list(checks)
    if checks:
        assert_none(checks)
    part, counts = target.with_name(target.name + ".part"), {}
    part.unlink(missing_ok=True)
    db = sqlite3.connect(part)
    try:
        quote = lambda name: '"' + name.replace('"', '""') + '"'
        for name, df in found.items():
            columns = [(f.name, SQLITE_TYPES.get(f.dataType.simpleString(), "TEXT")) for f in df.schema]
            listed = lambda names: ", ".join(map(quote, names))
            rules = [f"PRIMARY KEY ({listed(keys[name])})"] if keys and name in keys else []
            rules += [f"FOREIGN KEY ({listed(own)}) REFERENCES {quote(parent)} ({listed(theirs)})" for own, parent, theirs in (references or {}).get(name, [])]
            db.execute(f"CREATE TABLE {quote(name)} ({', '.join([f'{quote(c)} {t}' for c, t in columns] + rules)})")
            if (n := df.count()) > most_rows:
                raise ValueError(f"{name} has {n} rows, too many for one file")
            plain = df.select(*[F.col(f.name) if f.dataType.simpleString() in (*SQLITE_TYPES, "string") else F.to_json(f.name).alias(f.name) for f in df.schema])
            insert = f"INSERT INTO {quote(name)} VALUES ({', '.join('?' * len(columns))})"
            db.executemany(insert, (tuple(r) for r in plain.toLocalIterator()))
            counts[name] = db.execute(f"SELECT count(*) FROM {quote(name)}").fetchone()[0]
        db.execute("CREATE TABLE metadata (key TEXT PRIMARY KEY, value TEXT)")
        db.execute("INSERT INTO metadata VALUES ('schema_version', ?)", (str(schema_version),))
        for name, select in (views or {}).items():
            db.execute(f"CREATE VIEW {quote(name)} AS {select}")
        db.execute(f"PRAGMA user_version = {int(schema_version)}")
        db.commit()
        if db.execute("PRAGMA integrity_check").fetchone()[0] != "ok" or db.execute("PRAGMA foreign_key_check").fetchone() is not None:
            raise ValueError("the file isn't sound")
        db.close()
        os.link(part, target)
    finally:
        db.close()
        part.unlink(missing_ok=True)
    return counts


_MARKUP = re.compile(r"[\\`*_{}\[\]<>#|]")


def _plain(text: object) -> str:
    shown = str(text or "").replace("\r", "")
    return _MARKUP.sub(r"\\\g<0>", shown) if _MARKUP.search(shown) else shown


def page_path(record: dict) -> str:
    """Where a record's page is: by level for current records, by id and a hash of the key for observations."""
    if "feed_path" in record:
        return f"archive/feed-{re.sub(r'[^a-z0-9]', '', Path(record['feed_path']).stem.lower())}.md"
    if "archive_schema_version" in record:
        key = hashlib.sha256(f"{record.get('snapshot')}\0{record.get('page_entry_position')}\0{record['label']}".encode()).hexdigest()[:12]
        return f"archive/{record['id'] or 'unknown'}-{key}.md"
    return f"{'n' + str(record['jlpt_level']) if record.get('jlpt_level') else 'unclassified'}/{record['id']}.md"


def render(record: dict) -> str:
    """A record as Markdown; its texts can't be taken for markup."""
    lines = [f"# {_plain(record.get('title'))}", ""]
    if record.get("source_sections_complete") is False:
        lines += ["> Some sections of the source are left out.", ""]
    if record.get("observation_kind"):
        lines += [f"> An earlier observation of {_plain(record.get('archive_timestamp'))}.", ""]
    for name in ("meaning", "meaning_example", "reading", "romanized_label"):
        if record.get(name):
            lines += [f"- {name.replace('_', ' ')}: {_plain(record[name])}"]
    for title, key, body in (("Notes", "notes", "text"), ("Examples", "examples", "japanese"), ("Comments", "comments", "text"), ("Items", "items", "body_text")):
        rows = record.get(key) or []
        if rows:
            lines += ["", f"## {title}", ""]
        for r in rows:
            lines += [f"{int(r['position']) + 1}. {_plain(r.get(body) or r.get('body_text'))}"]
            lines += [f"   - {_plain(t['text'])}" for t in r.get("translations") or []]
            lines += [f"   - credit: {_plain(r['credits_raw'])}"] if r.get("credits_raw") else []
    licence = record.get("license") or {}
    lines += ["", f"Source: <{record.get('source_url')}>  ", f"Licence: [{_plain(licence.get('id'))}]({licence.get('url')})", ""]
    return "\n".join(lines)


def rendered(record_json: Column) -> Column:
    """Struct (path, body) of records given as JSON text; both null where there is no record."""
    import pandas as pd
    from pyspark.sql.types import StringType, StructField, StructType

    def run(rows: pd.Series) -> pd.DataFrame:
        loaded = [None if x is None else json.loads(x) for x in rows]
        return pd.DataFrame([(None, None) if r is None else (page_path(r), render(r)) for r in loaded], columns=["path", "body"])

    run.__annotations__ = {"rows": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(run, StructType([StructField("path", StringType()), StructField("body", StringType())]))(record_json)


def _checked(root: Path, name: str) -> Path:
    if not isinstance(name, str) or not re.fullmatch(PAGE, name):
        raise ValueError(f"not a page: {name}")
    path = root / name
    for p in (path, *path.parents):
        if p.is_symlink():
            raise ValueError(f"a link: {p}")
        if p == root:
            break
        if p.exists() and p.is_dir() == (p == path):
            raise ValueError(f"in the way of a page: {p}")
    return path


def update_pages(pages: dict[str, str], folder: str) -> dict[str, list[str]]:
    """Writes changed pages, removes obsolete ones, leaves the rest; {"updated", "removed", "unchanged"}.

    Only files that the folder's manifest lists with their hash are managed: a page that a person edited,
    and a file in a new page's place, are errors, found before anything is written.
    """
    fresh = {n: hashlib.sha256(b.encode()).hexdigest() for n, b in pages.items()}
    root, listed = _managed(folder, fresh)
    changed = {n for n in pages if listed.get(n) != fresh[n] or not (root / n).exists()}
    for name in changed:
        _placed(root, name, pages[name])
    return _finished(root, listed, fresh, changed)


def _managed(folder: str, fresh: dict[str, str]) -> tuple[Path, dict[str, str]]:
    """The folder, and the hashes by path of its manifest; an error if a page isn't as the manifest, or as the new pages, have it."""
    root = Path(folder).absolute()
    if root.is_symlink() or root.exists() and not root.is_dir():
        raise ValueError(f"not a folder: {folder}")
    listed: dict[str, str] = json.loads((root / MANIFEST).read_text()) if (root / MANIFEST).exists() else {}
    for name in {*listed, *fresh}:
        path = _checked(root, name)
        if path.exists() and hashlib.sha256(path.read_bytes()).hexdigest() not in ({listed[name], fresh.get(name)} if name in listed else ()):
            raise ValueError(f"edited, or not of this export: {name}")
    return root, listed


def _finished(root: Path, listed: dict[str, str], fresh: dict[str, str], changed: set[str]) -> dict[str, list[str]]:
    gone = [n for n in listed if n not in fresh]
    for name in gone:
        (root / name).unlink(missing_ok=True)
    if changed or gone or not (root / MANIFEST).exists():
        _placed(root, MANIFEST, json.dumps(fresh, sort_keys=True))
    return {"updated": sorted(changed), "removed": sorted(gone), "unchanged": sorted(set(fresh) - changed)}


def _placed(root: Path, name: str, body: str) -> None:
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f"{path.name}.{os.getpid()}.part")
    part.write_text(body)
    os.replace(part, path)


def update_page_table(made: DataFrame, folder: str) -> dict[str, list[str]]:
    """As update_pages, for a table (path, body) and a folder that driver and executors see.

    The driver gets paths and hashes only. What must not be changed is found before anything is written; then the
    executors write the changed pages, and the manifest comes last, so that a run that was cut off can be done again.
    """
    from pyspark import TaskContext

    hashed = made.select("path", F.sha2(F.col("body"), 256).alias("sha256")).collect()
    fresh = {r["path"]: r["sha256"] for r in hashed}
    if len(fresh) < len(hashed):
        raise ValueError("two records for one page")
    front = "# Pages\n\n" + "".join(f"- [{p}]({p})\n" for p in sorted(fresh))
    fresh["README.md"] = hashlib.sha256(front.encode()).hexdigest()
    root, listed = _managed(folder, fresh)
    changed = {n for n in fresh if listed.get(n) != fresh[n] or not (root / n).exists()}
    shared = made.sparkSession.sparkContext.broadcast(frozenset(changed))

    def place(rows: Iterable) -> None:
        assert TaskContext.get() is not None
        for r in rows:
            if r["path"] in shared.value:
                _placed(root, r["path"], r["body"])

    made.foreachPartition(place)
    if "README.md" in changed:
        _placed(root, "README.md", front)
    return _finished(root, listed, fresh, changed)


def write_report(path: str, report: dict) -> None:
    """A report as JSON, whole or not at all."""
    part = Path(path + ".part")
    part.write_text(json.dumps(report, ensure_ascii=False, indent=1, sort_keys=True))
    os.replace(part, path)
