"""Byte-level BPE by backtracking over longest matches, and decoding.

The tokens of a text by rank-ordered merging are the one sequence in which every two neighbours are
compatible: merging the two tokens' own bytes would leave both as they are. So a text is covered from
the left with the longest token at each position (found for all positions by one pass of an
Aho-Corasick automaton over the bytes mapped to Latin-1); where a token isn't compatible with the one
before, the next shorter token that is its prefix is tried, and then the one before is taken back.
A position that has been given up is never entered again, so the work is linear in the bytes. Whether
two tokens are compatible is found from the merges that made them and remembered.

Each match of the split pattern is encoded by itself. Words repeat, so the ids of recent matches are
remembered; when that memory is full it starts anew.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from inkspar.llm.common import free_name, only

#: Remembered matches of the split pattern, in each worker, and the longest that is remembered.
CACHED, CACHED_BYTES = 800_000, 64
#: Texts whose ids are held at once, at most, and ids after which no further text joins them.
TOGETHER, TOGETHER_IDS = 500, 1 << 22
#: Remembered pairs of tokens, in each worker.
CACHED_PAIRS = 200_000


class Encoder:
    """The encoder of a rank table (token bytes -> rank); single bytes are all tokens, and lower ranks merge first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.token = ranks, {r: t for t, r in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.known: dict[tuple[int, int], bool] = {}
        self.shorter: dict[int, int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            self.parts[rank] = self._split(token, rank)
        self.known.clear()
        self.cache = _Pieces(self, lambda ids: " ".join(map(str, ids)))
        self.packed = _Pieces(self, lambda ids: np.array(ids, np.int32).tobytes())

    def _split(self, token: bytes, rank: int) -> tuple[int, int]:
        """The two tokens whose merge gives the token; (rank, rank) if no merge of lower ranks ends in two."""
        ranks = self.ranks
        for cut in range(len(token) - 1, 0, -1):
            left, right = ranks.get(token[:cut], rank), ranks.get(token[cut:], rank)
            if left < rank and right < rank and self._compatible(left, right):
                self.merged[left, right] = rank
                return left, right
        return rank, rank

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both, side by side, ends in just these two tokens.

        Undoes the later of the two merges again and again; at each step a merge across the border that
        would have come before the undone one shows that the two don't stay apart.
        """
        parts, merged, limit = self.parts, self.merged, 1 << 62
        while True:
            if merged.get((left, right), limit) < limit:
                return False
            if left > right:
                whole, limit = left, left
                left = parts[whole][1]
                if left != whole:
                    continue
                whole, limit = right, right + 1
                right = parts[whole][0]
            else:
                whole, limit = right, right + 1
                right = parts[whole][0]
                if right != whole:
                    continue
                whole, limit = left, left
                left = parts[whole][1]
            if (left if limit == whole else right) == whole:
                return True

    def compatible(self, left: int, right: int) -> bool:
        found = self.known.get((left, right))
        if found is None:
            if len(self.known) >= CACHED_PAIRS:
                self.known.clear()
            found = self.known[left, right] = self._compatible(left, right)
        return found

    def _next_shorter(self, rank: int) -> int:
        """The longest token that is a proper prefix of the token; -1 for a single byte."""
        found = self.shorter.get(rank)
        if found is None:
            token, ranks = self.token[rank], self.ranks
            found = self.shorter[rank] = next((ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ranks), -1)
        return found

    def encode_bytes(self, data: bytes) -> list[int]:
        """The ids of bytes that the pattern doesn't cut."""
        n = len(data)
        if n == 0:
            return []
        longest = [0] * n
        for end, (rank, size) in self.automaton.iter(data.decode("latin-1")):
            if size > 1 or not longest[end]:
                longest[end - size + 1] = rank  # matches with one start end later the longer they are
        if n == len(self.token[longest[0]]):
            return [longest[0]]  # a match that is a token stays whole
        open_, ids, at = bytearray(b"\x01") * (n + 1), [], 0
        length, now = self.token, longest[0]
        while True:
            end = at + len(length[now])
            if open_[end] and (not ids or self.compatible(ids[-1], now)):
                ids.append(now)
                at = end
                if at == n:
                    return ids
                now = longest[at]
                continue
            now = self._next_shorter(now)
            while now < 0:
                open_[at] = 0
                now = ids.pop()
                at -= len(length[now])
                now = self._next_shorter(now)

    def ids_text(self, text: str) -> str:
        """The decimal ids of a whole text, joined by spaces."""
        return " ".join(map(self.cache.__getitem__, self.pattern.findall(text)))

    def ids_array(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        return np.frombuffer(b"".join(map(self.packed.__getitem__, self.pattern.findall(text))), np.int32)

    def encode(self, text: str) -> list[int]:
        return self.ids_array(text).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.token[i] for i in ids])


class _Pieces(dict):
    """What a match of the pattern is encoded to; a missing one is encoded, and remembered if short.

    When half of CACHED are held they become the older half, from which what is asked for again comes back.
    """

    def __init__(self, own: Encoder, form):
        self.own, self.form, self.older = own, form, {}

    def __missing__(self, piece: str):
        found = self.older.get(piece)
        if found is None:
            data = piece.encode("utf-8", "surrogatepass")
            found = self.form(self.own.encode_bytes(data))
            if len(data) > CACHED_BYTES:
                return found
        if len(self) >= CACHED // 2:
            self.older = dict(self)
            self.clear()
        self[piece] = found
        return found


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line for each token, its bytes in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a rank file, kept in a worker process until another operator's tables take its place."""
    return only(("bpe", path, pattern), lambda: Encoder(read_ranks(path), pattern))


_DIGESTS = StructType([StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])


_CODED = StructType([StructField("ids", ArrayType(IntegerType())), StructField("round_trip", BooleanType())])


def _id_lists(texts: pa.Array, own: Encoder) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(place of the first text, ids of each) for a few texts at a time, so that no array outgrows its 32-bit offsets."""
    at, held, size = 0, [], 0
    for x in texts:
        held.append(own.ids_array(x.as_py() or ""))
        size += len(held[-1])
        if len(held) == TOGETHER or size >= TOGETHER_IDS:
            yield at, held
            at, held, size = at + len(held), [], 0
    if held:
        yield at, held


def _listed(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate(ids)))


def encode_column(text: Column, path: str, pattern: str) -> Column:
    """The ids, an array of int; empty for a null text.

    The rank file must be at the same path on all executors, as an installed package's files are.
    """

    @F.arrow_udf(ArrayType(IntegerType()))
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(path, pattern)
        for batch in batches:
            for _, ids in _id_lists(batch, own):
                yield _listed(ids)

    return encoded(text)


def checked_column(text: Column, path: str, pattern: str) -> Column:
    """Struct (ids, round_trip): the ids, and whether decoding them gives the text again; in one pass, with one encoder. A null text has no ids, and these decode to it."""

    @F.arrow_udf(_CODED)
    def checked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(path, pattern)
        for batch in batches:
            for at, ids in _id_lists(batch, own):
                texts = batch[at : at + len(ids)]
                same = [own.decode(i.tolist()) == (t.as_py() or "").encode("utf-8", "surrogatepass") for i, t in zip(ids, texts, strict=True)]
                yield pa.StructArray.from_arrays([_listed(ids), pa.array(same, pa.bool_())], ["ids", "round_trip"])

    return checked(text)


def decode_column(ids: Column, path: str, pattern: str) -> Column:
    """The bytes of ids, which are an array of int; a null array gives null, an id that isn't in the rank file is an error."""

    @F.arrow_udf(BinaryType())
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(path, pattern)
        for rows in batches:
            for at in range(0, len(rows), TOGETHER):
                yield pa.array([None if x is None else own.decode(x) for x in rows[at : at + TOGETHER].to_pylist()], pa.binary())

    return decoded(ids)


def digest_column(text: Column, path: str, pattern: str) -> Column:
    """Struct (n_tokens, ids_sha256, decoded_sha256) of the encoded and again decoded text, in one pass; a null text is as an empty one."""

    @F.arrow_udf(_DIGESTS)
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own, sha = encoder(path, pattern), hashlib.sha256
        table = {str(r): t for r, t in own.token.items()}
        for texts in batches:
            n, coded, decoded = [], [], []
            for x in texts:
                ids = own.ids_text(x.as_py() or "")
                parts = ids.split()
                n.append(len(parts))
                coded.append(sha(ids.encode()).hexdigest())
                decoded.append(sha(b"".join([table[i] for i in parts])).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], _DIGESTS.names)

    return digests(text)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """docs with the columns ids (array of int) and n_tokens.

    Defined results: null and empty texts have no ids; an empty table stays empty; every other column,
    of whatever name, stays as it is, but ids and n_tokens are replaced.
    """
    return docs.withColumn("ids", encode_column(F.col(text_col), path, pattern)).withColumn("n_tokens", F.size("ids").cast("bigint"))


def encode_checked(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """docs with the columns ids (array of int), n_tokens and round_trip (whether decoding gives the text again).

    Defined results: as encode; a null text is as an empty one; columns named ids, n_tokens or round_trip are replaced, all others stay.
    """
    made = free_name(docs, "coded")
    out = docs.withColumn(made, checked_column(F.col(text_col), path, pattern))
    return out.withColumn("ids", F.col(made)["ids"]).withColumn("n_tokens", F.size("ids").cast("bigint")).withColumn("round_trip", F.col(made)["round_trip"]).drop(made)


def decode(docs: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """docs with the column decoded (binary), which replaces one of that name; null ids give null, no ids no bytes, and an empty table stays empty."""
    return docs.withColumn("decoded", decode_column(F.col(ids_col), path, pattern))
