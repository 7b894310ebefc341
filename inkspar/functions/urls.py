"""URL scope, labels and replay addresses. A Scope holds what a collection admits."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import parse_qs, quote, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Characters that stay as they are in a quoted address.
SAFE = "/:?=&;%+@!()*,-._~'"
_PORTS = {None, 80, 443}


@dataclass(frozen=True)
class Scope:
    """A collection's pages: hosts, the page path, the query field that labels a page, and the feeds' paths; archive_host replays captures."""

    hosts: tuple[str, ...]
    page_path: str
    label_field: str
    date_field: str = "date"
    feed_paths: tuple[str, ...] = ()
    archive_host: str = "archive.example.org"

    def label(self, url: str | None) -> str | None:
        """The label of a page's URL; null if any part of it is outside the scope."""
        try:
            at = urlsplit(url or "")
            inside = at.scheme in ("http", "https") and at.hostname in self.hosts and at.port in _PORTS and at.path.lower() == self.page_path.lower()
        except ValueError:
            return None
        if not inside or at.fragment:
            return None
        fields = parse_qs(at.query, keep_blank_values=True)
        labels, dates = fields.pop(self.label_field, []), fields.pop(self.date_field, None)
        if fields or len(labels) != 1 or not labels[0]:
            return None
        if dates is not None and not (len(dates) == 1 and re.fullmatch(r"\d{4}-\d{1,2}-\d{1,2}", dates[0])):
            return None
        return labels[0]

    def replay(self, url: str | None) -> tuple[str, str] | None:
        """(timestamp, original) of a replay address whose original is a page or feed of the scope."""
        found = re.fullmatch(rf"https://{re.escape(self.archive_host)}/web/(\d{{14}})(?:id_)?/(https?://.*)", url or "")
        if not found:
            return None
        at = urlsplit(found[2])
        feed = at.hostname in self.hosts and at.port in _PORTS and at.path in self.feed_paths and not at.query and not at.fragment
        return (found[1], found[2]) if feed or self.label(found[2]) is not None else None

    def archive_url(self, timestamp: str, original: str) -> str:
        return quote(f"https://{self.archive_host}/web/{timestamp}id_/{original}", safe=SAFE)


def label_column(url: Column, scope: Scope) -> Column:
    @F.pandas_udf(StringType())
    def labels(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for urls in batches:
            yield urls.map(scope.label)

    return labels(url)


def quoted(url: Column) -> Column:
    """Percent-encoded, but for SAFE and unreserved characters."""

    @F.pandas_udf(StringType())
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for urls in batches:
            yield urls.map(lambda x: None if x is None else quote(x, safe=SAFE))

    return made(url)


def part(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit(name))


def in_scope(url: Column, scheme: str, host: str, path_pattern: str) -> Column:
    """A page address of one host: scheme, host, no fragment, and a path that the pattern covers."""
    return F.coalesce((part(url, "PROTOCOL") == scheme) & (part(url, "HOST") == host) & part(url, "REF").isNull() & part(url, "PATH").rlike(f"^(?:{path_pattern})$"), F.lit(False))


def replay_parts(url: Column) -> Column:
    """Struct (timestamp, original) of any replay address; both null if it has another shape."""
    shape = r"^https://[^/]+/web/(\d{14})(?:id_)?/(https?://.*)$"
    return F.struct(*[F.nullif(F.regexp_extract(url, shape, i), F.lit("")).alias(name) for i, name in ((1, "timestamp"), (2, "original"))])
