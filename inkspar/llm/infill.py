"""Fill-in-middle documents: a text is cut at two of its units (lines, unless told otherwise) and its middle moved to the end.

An Arrow-batched pandas UDF finds the units with the regex library's ``finditer``, left to right over code points, and keeps only
where each ends, in a compact array of 32-bit numbers; two look-ups there give the slices, whatever the number of units. The draws
come from the SHA-256 of ``seed:doc_id``, so a row's result depends on its id and text alone, and a lost task gives the same rows again.

Let h1 to h4 be the first four 32-bit groups of that hash and n the number of units. The prefix ends behind the smaller of
h1 mod (n + 1) and h2 mod (n + 1) units, the middle behind the larger. A row is left as it is (form ``plain``) if h3 mod 100 is at least
``percent``, else it is ``spm`` if h4 mod 100 is below ``spm_percent``, else ``psm``. Texts that contain a sentinel stay plain, so that the
sentinels of an output can be found again and ``restored`` gives the exact text.

Defined results: null and empty texts are plain with no units and an empty output; a null id has the seed's hash with nothing behind the
colon; rows that repeat get the same result; characters that no unit covers, with a pattern of the caller's, belong to the following unit,
and those behind the last one to the suffix; an empty table gives no rows; columns named as the results are replaced, all others stay.
"""

from __future__ import annotations

import hashlib
from array import array
from dataclasses import dataclass

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspar.llm.common import free_name

LINES = r"[^\n]*\n|[^\n]+"
PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Settings:
    """The law of the transformation: sentinels, shares of a hundred, the seed and the pattern of a unit."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    percent: int = 100
    spm_percent: int = 50
    seed: int = 7
    unit: str = LINES

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        # Marks that open with a character which none has further on can't be made by a cut: no text runs into one.
        if not all(marks) or len(set(marks)) < 3 or any(m[0] in other[1:] for m in marks for other in marks) or any(m != other and other.startswith(m) for m in marks for other in marks):
            raise ValueError("sentinels must be different, none the start of another, and none may hold another's first character behind its own first")


def unit_ends(pattern: regex.Pattern, text: str) -> array:
    """Where each unit ends, in code points."""
    return array("I", [m.end() for m in pattern.finditer(text)])


def draws(seed: int, doc_id: int | None) -> list[int]:
    """The first four 32-bit groups of the row's hash."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def rearranged(law: Settings, pattern: regex.Pattern, doc_id: int | None, text: str) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of the prefix and of the middle, output)."""
    ends = unit_ends(pattern, text)
    n = len(ends)
    h1, h2, h3, h4 = draws(law.seed, doc_id)
    if not text or h3 % 100 >= law.percent or any(mark in text for mark in (law.prefix, law.suffix, law.middle)):
        return n, PLAIN, None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[low - 1] if low else 0), (ends[high - 1] if high else 0)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < law.spm_percent:
        return n, SPM, a, b - a, f"{law.suffix}{suffix}{law.prefix}{prefix}{law.middle}{middle}"
    return n, PSM, a, b - a, f"{law.prefix}{prefix}{law.suffix}{suffix}{law.middle}{middle}"


def put_back(law: Settings, form: str | None, output: str) -> str:
    """The text that an output was made from."""
    if form not in (PSM, SPM):
        return output
    first, second = (law.prefix, law.suffix) if form == PSM else (law.suffix, law.prefix)
    if not output.startswith(first):
        raise ValueError("an output doesn't open with its form's sentinel")
    one, _, rest = output[len(first) :].partition(second)
    two, _, middle = rest.partition(law.middle)
    return one + middle + two if form == PSM else two + middle + one


_RESULT = "units long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string"


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def infill_column(doc_id: Column, text: Column, law: Settings = Settings()) -> Column:
    """Struct (units, form, prefix_chars, middle_chars, output, output_sha256) of a row."""

    @F.pandas_udf(_RESULT)
    def infilled(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        pattern = regex.compile(law.unit)
        rows = [rearranged(law, pattern, None if i == "" else int(i), t or "") for i, t in zip(ids, texts, strict=True)]
        found = pd.DataFrame(rows, columns=["units", "form", "prefix_chars", "middle_chars", "output"], dtype=object)
        found["output_sha256"] = [_sha256(x) for x in found["output"]]
        return found.astype({"units": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    # Ids travel as text: pandas would make floats of integers beside nulls.
    return infilled(F.coalesce(doc_id.cast("long").cast("string"), F.lit("")), text)


def restored_column(form: Column, output: Column, law: Settings = Settings()) -> Column:
    """Struct (text, sha256): the text rebuilt from an output and its form alone."""

    @F.pandas_udf("text string, sha256 string")
    def rebuilt(forms: pd.Series, outputs: pd.Series) -> pd.DataFrame:
        texts = [put_back(law, f, o or "") for f, o in zip(forms, outputs, strict=True)]
        return pd.DataFrame({"text": texts, "sha256": [_sha256(t) for t in texts]}, dtype=object)

    return rebuilt(form, output)


RESULT = ["units", "form", "prefix_chars", "middle_chars", "output", "output_sha256"]


def infill(docs: DataFrame, law: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the columns RESULT; the only work is one pass over the rows, without a shuffle."""
    found = free_name(docs, "found")
    kept = [c for c in docs.columns if c.lower() not in RESULT]
    return docs.withColumn(found, infill_column(F.col(id_col), F.col(text_col), law)).select(*[f"`{c}`" for c in kept], *[F.col(found)[c].alias(c) for c in RESULT])
