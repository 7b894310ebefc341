"""The schemas of records, as DDL; nothing is inferred."""

from __future__ import annotations

_LICENCE = "license: struct<id: string, url: string>"
_DATES = "original_created_at: string, original_updated_at: string"
_SEGMENTS = "segments: array<struct<text: string, grammar_highlight: boolean>>"

EXAMPLE = f"source_id: bigint, position: int, japanese: string, japanese_html: string, {_SEGMENTS}, reading: string, credits_raw: string, translations: array<struct<language: string, text: string, html: string, {_SEGMENTS}>>, {_DATES}"
COMMENT = f"position: int, source_id: bigint, text: string, html: string, credits_raw: string, content_sha256: string, {_DATES}"
SECTION = "kind: string, source_dom_id: string, body_text: string, body_html: string, credits_raw: string"

#: A current record.
ENTRY = (
    f"schema_version int, id bigint, source string, source_url string, {_LICENCE.replace(':', '', 1)}, title string, romanized_label string, alternate_forms array<string>, jlpt_level int, credits_raw string, "
    f"meaning string, meaning_example string, meaning_notes array<struct<language: string, text: string, html: string>>, sections array<struct<{SECTION}>>, formations array<string>, examples array<struct<{EXAMPLE}>>, "
    f"comments array<struct<{COMMENT}>>, related_entries array<struct<target_id: bigint, label: string, source_url: string>>, {_DATES.replace(':', '')}, retrieved_at string, response_sha256 string, warnings array<string>"
)

_NOTE = f"position: int, text: string, html: string, credits_raw: string, source_id: bigint, {_DATES}"
#: A historical record, without the entries nested in it.
OBSERVATION = (
    f"archive_schema_version int, source string, id bigint, label string, title_raw string, title string, reading string, romanized_label string, category string, jlpt_level_original string, meaning string, meaning_example string, "
    f"credits_raw string, source_url string, archive_url string, archive_timestamp string, retrieved_at string, archive_digest string, response_sha256 string, encoding string, {_LICENCE.replace(':', '', 1)}, license_links array<string>, "
    f"notes array<struct<{_NOTE}>>, examples array<struct<source_id: bigint, position: int, japanese: string, body_text: string, body_html: string, credits_raw: string, verification_class: array<string>, {_DATES}>>, comments array<struct<{_NOTE}>>, "
    f"related_entries array<struct<position: int, target_label: string, label: string, annotation_text: string, annotation_html: string, credits_raw: string>>, sections array<struct<kind: string, text: string, html: string>>, "
    f"{_DATES.replace(':', '')}, warnings array<string>, snapshot string, page_entry_position int, observation_kind string, source_sections_complete boolean"
)

#: A feed.
FEED = (
    f"feed_schema_version int, source string, feed_path string, source_url string, archive_url string, archive_timestamp string, retrieved_at string, response_sha256 string, title string, description string, channel_xml string, {_LICENCE.replace(':', '', 1)}, license_basis string, "
    "items array<struct<position: int, label: string, entry_id: bigint, title: string, source_url: string, pub_date_raw: string, author_raw: string, creator_raw: string, guid: string, description_raw_html: string, body_html: string, body_text: string, item_xml: string>>, "
    "warnings array<string>, review_required array<struct<position: int, link: string, reason: string>>"
)
