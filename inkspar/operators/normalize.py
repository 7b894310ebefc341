"""Nested records to flat relations, their constraints, and the search views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expand_components(pages: DataFrame, nested: str, key: str, shared: list[str]) -> DataFrame:
    """Every page's own entry (position 0) and its nested entries, in one level, with page_key and page_position.

    Nested entries must agree with their page in the shared columns; disagrees tells which don't.
    """
    inner = next(f.dataType.elementType for f in pages.schema if f.name == nested)
    own = pages.select(F.col(key).alias("page_key"), F.lit(0).alias("page_position"), *[F.col(f.name) for f in inner], F.lit(False).alias("disagrees"))
    below = pages.select(F.col(key).alias("page_key"), F.struct(*shared).alias("__page"), F.posexplode(nested).alias("__at", "__entry"))
    differs = reduce(lambda a, b: a | b, [~F.col(f"__page.{c}").eqNullSafe(F.col(f"__entry.{c}")) for c in shared], F.lit(False))
    return own.unionByName(below.select("page_key", (F.col("__at") + 1).alias("page_position"), *[F.col(f"__entry.{f.name}").alias(f.name) for f in inner], differs.alias("disagrees")))


def child_relation(records: DataFrame, key: str, key_as: str, items: str, fields: dict[str, str | Column], stored_position: bool = False) -> DataFrame:
    """One row for each item of an array: the record's key, the position, and the fields (name -> field of the item, or a column over item)."""
    rows = records.select(F.col(key).alias(key_as), F.posexplode(items).alias("__at", "item"))
    position = F.col("item.position") if stored_position else F.col("__at")
    return rows.select(key_as, position.cast("int").alias("position"), *[(F.col(f"item.{f}") if isinstance(f, str) else f).alias(name) for name, f in fields.items()])


def relations(entries: DataFrame) -> dict[str, DataFrame]:
    """The relations of current records (id, scalar fields, nested lists; record_json holds the whole)."""
    part = lambda items, fields, stored=False: child_relation(entries, "id", "entry_id", items, fields, stored)
    scalar = lambda items, name: child_relation(entries, "id", "entry_id", items, {name: F.col("item")})
    examples = part("examples", {"source_id": "source_id", "japanese": "japanese", "japanese_html": "japanese_html", "reading": "reading", "credits_raw": "credits_raw", "segments_json": F.to_json("item.segments"), "translations": "translations"}, True)
    translations = child_relation(examples.withColumn("__key", F.struct("entry_id", "source_id")), "__key", "__key", "translations", {"language": "language", "body_text": "text", "body_html": "html", "segments_json": F.to_json("item.segments")})
    return {
        "entries": entries.drop("alternate_forms", "meaning_notes", "sections", "formations", "examples", "comments", "related_entries"),
        "entry_forms": scalar("alternate_forms", "form"),
        "meaning_notes": part("meaning_notes", {"language": "language", "body_text": "text", "body_html": "html"}),
        "sections": part("sections", {"kind": "kind", "source_dom_id": "source_dom_id", "body_text": "body_text", "body_html": "body_html", "credits_raw": "credits_raw"}),
        "formations": scalar("formations", "formation"),
        "examples": examples.drop("translations"),
        "translations": translations.select("__key.entry_id", F.col("__key.source_id").alias("example_id"), "position", "language", "body_text", "body_html", "segments_json"),
        "comments": part("comments", {"body_text": "text", "body_html": "html", "credits_raw": "credits_raw", "content_sha256": "content_sha256"}, True),
        "related_entries": part("related_entries", {"target_id": "target_id", "label": "label", "source_url": "source_url"}),
    }


def archive_relations(entries: DataFrame) -> dict[str, DataFrame]:
    """The relations of historical records; key names each observation."""
    part = lambda items, fields: child_relation(entries, "key", "entry_key", items, fields, True)
    return {
        "archive_entries": entries.withColumnRenamed("id", "source_id").withColumnRenamed("jlpt_level_original", "original_jlpt_level").drop("notes", "examples", "comments", "related_entries"),
        "archive_notes": part("notes", {"body_text": "text", "body_html": "html", "credits_raw": "credits_raw"}),
        "archive_examples": part("examples", {"source_id": "source_id", "japanese": "japanese", "body_text": "body_text", "body_html": "body_html", "credits_raw": "credits_raw", "verification_class_json": F.to_json("item.verification_class")}),
        "archive_comments": part("comments", {"credits_raw": "credits_raw", "body_text": "text", "body_html": "html"}),
        "archive_relationships": part("related_entries", {"target_label": "target_label", "label": "label", "annotation_text": "annotation_text", "annotation_html": "annotation_html", "credits_raw": "credits_raw"}),
    }


def feed_relations(feeds: DataFrame) -> dict[str, DataFrame]:
    items = {n: n for n in ("label", "entry_id", "title", "source_url", "pub_date_raw", "author_raw", "creator_raw", "guid", "description_raw_html", "body_html", "body_text", "item_xml")}
    return {"archive_feeds": feeds.withColumnRenamed("feed_path", "path").drop("items"), "archive_feed_items": child_relation(feeds, "feed_path", "feed_path", "items", items, True)}


def _lines(first: str, *more: str) -> Column:
    return F.concat(F.col(first), *[x for m in more for x in (F.chr(F.lit(10)), F.coalesce(F.col(m), F.lit("")))])


def _view(parts: list[tuple[str, DataFrame, str, Column | str]], key: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.select(F.col(own).alias(key), F.lit(kind).alias("kind"), (F.col(body) if isinstance(body, str) else body).alias("text")) for kind, df, own, body in parts])


def search_view(found: dict[str, DataFrame]) -> DataFrame:
    """(entry_id, kind, text) of everything that can be searched. A filter on kind reads one relation."""
    return _view([("entry", found["entries"], "id", _lines("title", "meaning", "meaning_example")), ("section", found["sections"], "entry_id", "body_text"), ("example", found["examples"], "entry_id", _lines("japanese", "reading")), ("translation", found["translations"], "entry_id", "body_text"), ("comment", found["comments"], "entry_id", "body_text")], "entry_id")


def archive_search_view(found: dict[str, DataFrame]) -> DataFrame:
    return _view([("entry", found["archive_entries"], "key", _lines("title", "meaning"))] + [(kind, found[name], "entry_key", body) for kind, name, body in (("note", "archive_notes", "body_text"), ("example", "archive_examples", "body_text"), ("comment", "archive_comments", "body_text"), ("relationship", "archive_relationships", "annotation_text"))], "entry_key")


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """The values of a key that more than one row has, and how many."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def orphans(child: DataFrame, columns: list[str], parent: DataFrame, keys: list[str]) -> DataFrame:
    """Child rows whose reference is complete and has no parent."""
    there = parent.select(*[F.col(k).alias(c) for c, k in zip(columns, keys, strict=True)]).distinct()
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return child.filter(complete).join(there, columns, "left_anti")


def violations(checks: list[tuple[str, DataFrame]]) -> DataFrame:
    """(check_name, n_rows) for each check's offending rows; 0 where it holds."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("check_name"), "n_rows") for name, df in checks])


def assert_none(checks: list[tuple[str, DataFrame]]) -> None:
    """Raises ValueError with the names of the checks that don't hold."""
    failed = [f"{r['check_name']}: {r['n_rows']} rows" for r in violations(checks).filter("n_rows > 0").collect()]
    if failed:
        raise ValueError("; ".join(failed))
