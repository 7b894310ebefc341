"""Licence links and declarations.

A link is judged by the segments of its path. A declaration is read word by word: each word becomes a letter for what
it can be in a licence's name, so that a name is a shape in a string of such letters, and its kind follows from that.
Every function has a form for columns and one, ending in ``_in_text`` or ``_url``, for a single text on the driver or in a worker.
"""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whose licences are meant, which of them is the data licence, and the phrases that restrict use.
HOSTS = ("creativecommons.org", "www.creativecommons.org")
FAMILY, KIND, VERSION = "licenses", "by-sa", "2.0"
ENDINGS = ("", "legalcode")
PHRASES = ("all rights reserved", "noncommercial", "non commercial", "no copying", "no redistribution")

#: The letter of each word that has a part in a name; V is the data licence's version, N another number, L any other word of letters, x the rest.
_LETTERS = {"cc": "C", "creative": "R", "commons": "M", "by": "B", "sa": "S", VERSION: "V"}
#: A name: its maker, BY, further words, a version; and the data licence's.
_NAME, _OWN = "(?:C|RM)B[CRMBSL]*[VN]", "^(?:C|RM)BSV$"
_ADDRESS = r"https?://[^\s<>\"']+"


def _words(text: str) -> list[str]:
    """Lower-cased words; what isn't an ASCII letter, digit, full stop within a word, space or hyphen stands alone."""
    return [w.rstrip(".") or "." for w in re.sub(r"[^\w.\s-]", " | ", text.lower(), flags=re.ASCII).replace("-", " ").split()]


def _letter(word: str) -> str:
    return _LETTERS.get(word) or ("N" if word[0] in "0123456789" else "L" if re.fullmatch("[a-z]+", word) else "x")


def is_data_licence_url(url: str) -> bool:
    try:
        parts = urlsplit(url)
        host = parts.hostname
    except ValueError:
        return False
    at = parts.path.split("/")
    return parts.scheme in ("http", "https") and host in HOSTS and at[:4] == ["", FAMILY, KIND, VERSION] and len(at) <= 5 and (len(at) == 4 or at[4] in ENDINGS or re.fullmatch(r"deed\.[\w-]+", at[4]) is not None)


def links_in_text(text: str) -> list[str]:
    """The addresses of licences of the family, whichever they are."""
    return [u for u in re.findall(_ADDRESS, text) if urlsplit(u).netloc in HOSTS and urlsplit(u).path.startswith(f"/{FAMILY}/") and len(urlsplit(u).path) > len(FAMILY) + 2]


def names_in_text(text: str) -> list[str]:
    """The names of licences, each as its words' letters."""
    return re.findall(_NAME, "".join(map(_letter, _words(text))))


def restricts_in_text(text: str) -> bool:
    spaced = " " + " ".join(_words(text))
    return any(f" {p}" in spaced for p in PHRASES)


def conflicts_in_text(text: str, is_licence_field: bool = False) -> bool:
    links, names = links_in_text(text), names_in_text(text)
    named = bool(links or names)
    return restricts_in_text(text) or not all(map(is_data_licence_url, links)) or not all(re.match(_OWN, n) for n in names) or (is_licence_field and text.strip() != "" and not named)


def is_data_licence(url: Column) -> Column:
    part = lambda name: F.try_parse_url(url, F.lit(name))
    at = F.split(part("PATH"), "/")
    whole = F.slice(at, 1, 4) == F.array(*map(F.lit, ("", FAMILY, KIND, VERSION)))
    last = F.get(at, F.lit(4))
    ending = F.when(F.size(at) == 4, True).when(F.size(at) == 5, last.isin(*ENDINGS) | last.rlike(r"^deed\.[\w-]+$")).otherwise(False)
    return F.coalesce(part("PROTOCOL").isin("http", "https") & part("HOST").isin(*HOSTS) & whole & ending, F.lit(False))


def links_in(text: Column) -> Column:
    """As links_in_text."""
    family = lambda u: F.try_parse_url(u, F.lit("HOST")).isin(*HOSTS) & F.try_parse_url(u, F.lit("PATH")).rlike(f"^/{FAMILY}/.")
    return F.filter(F.regexp_extract_all(text, F.lit(_ADDRESS), F.lit(0)), lambda u: F.coalesce(family(u), F.lit(False)))


def _word_column(text: Column) -> Column:
    spaced = F.regexp_replace(F.regexp_replace(F.lower(text), r"[^\w.\s-]", " | "), r"[\s-]+", " ")
    return F.transform(F.split(F.trim(spaced), " "), lambda w: F.regexp_replace(w, r"\.+$", ""))


#: What stands between two words of a text, before and after it is cut into words; a word's begin.
_GAP, _BEGIN = r"\.*[\s-]+", r"(?<![\w.])"
#: The first two words of any name: where there are none there is no name, and before them none begins.
_OPENING = _BEGIN + f"(?:cc|creative{_GAP}commons){_GAP}by"
_RESTRICTING = _BEGIN + "(?:" + "|".join(p.replace(" ", _GAP) for p in PHRASES) + ")"


def names_in(text: Column) -> Column:
    """As names_in_text. Only what stands behind the first opening of a name is read word by word."""

    def letter(w: Column) -> Column:
        known = reduce(lambda found, x: found.when(w == x[0], F.lit(x[1])), list(_LETTERS.items())[1:], F.when(w == "cc", F.lit("C")))
        return known.when(w.rlike("^[0-9]"), F.lit("N")).when(w.rlike("^[a-z]+$"), F.lit("L")).otherwise(F.lit("x"))

    lowered = F.lower(text)
    at = F.regexp_instr(lowered, F.lit(_OPENING))
    found = F.regexp_extract_all(F.array_join(F.transform(_word_column(F.substr(lowered, at)), letter), ""), F.lit(_NAME), F.lit(0))
    return F.when(at > 0, found).when(at == 0, F.array().cast("array<string>"))


def restricts(text: Column) -> Column:
    """As restricts_in_text, by one pattern over the text."""
    return F.lower(text).rlike(_RESTRICTING)


def conflicts(text: Column, is_licence_field: Column | None = None) -> Column:
    """Whether a rights declaration speaks against the data licence: another licence's link or name, restricting phrases, or a licence field that names none."""
    links, names = links_in(text), names_in(text)
    other = F.exists(links, lambda u: ~is_data_licence(u)) | F.exists(names, lambda n: ~n.rlike(_OWN))
    unknown = F.lit(False) if is_licence_field is None else is_licence_field & (F.trim(text) != "") & (F.size(links) == 0) & (F.size(names) == 0)
    return F.coalesce(restricts(text) | other | unknown, F.lit(False))


def gate(links: Column) -> Column:
    """For a page's licence links: at least one, and all of them the data licence."""
    return F.coalesce((F.size(links) > 0) & F.forall(links, is_data_licence), F.lit(False))
