"""Language identification by words first, then shorter and shorter character n-grams.

A word is a run of letters (Unicode's categories L), lower-cased. Training counts every word of every labelled text, by
language, with partial counts from each batch of texts and a sum by (word, language). Character n-grams of all lengths
are then counted over the different words, weighted by their counts. Runs of over ``WORD_CHARS`` letters, as scripts
without spaces have them, are counted by their n-grams, whole. All counts stay in a table: a model has every word and n-gram of its texts.

A word of the model adds its log frequency in each language, where a language borrows ``PRIOR`` counts
from the frequencies over all languages, so that one with few texts isn't favoured by words it lacks. Any other word is scored by the longest
n-grams, with word borders marked, of which the model has at least one: the mean of the known ones'
log frequencies stands for the word (a word without any says nothing). A text gets the language with the
largest sum, and as score that language's share after a softmax of the sums divided by the root of
the number of words, from 0 to 1.

The most frequent words, at most ``max_words`` and ``CELLS`` by their languages, are in the workers and summed there, text by text. All others are sent on, each once for a text with its count,
and looked up in the model's table by a join; those that it lacks are cut into n-grams, once for each different word, and these are joined in turn. So ``max_words`` bounds
what is broadcast and moves work between workers and joins, but changes no result. The words that most texts send on, ``HOT`` at most, meet their rows by a broadcast of these alone, so that no task
gets all rows of one word. Where rows of texts are not needed any more, ``keep_text=False`` leaves them out of the table that lineage is cut with.

Defined results: texts that are null or without a letter get "und" and score 0; rows without a label or
text aren't learned from; without any labelled row everything is "und"; ties go to the language first
in order of name; an empty table gives no rows; rows that repeat are judged alike; columns named lang_pred and score are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspar.llm.common import free_name, frequent_floor, release, text_key, written

UNKNOWN = "und"
LONGEST_GRAM = 4
#: The most log frequencies, words by languages, that are broadcast.
CELLS = 800_000
#: Bytes of text that a worker cuts into words and looks up at a time.
TOGETHER = 8 << 20
#: Words that the workers lack and that come in the most texts.
HOT = 5_000
#: Different (language, word) pairs that a task holds before it sends their counts on.
HELD = 200_000
#: Longer words (runs of a script without spaces) are counted and scored by their n-grams only.
WORD_CHARS = 40
#: Counts that each language borrows from all languages together.
PRIOR = 10.0
_RUN = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    """The lower-cased runs of letters. The pattern's runs can hold numbers that aren't decimal digits, at which they are cut."""
    found = _RUN.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in ("".join(c if c.isalpha() else " " for c in run).split())]


#: Letters that str.lower treats by what is around them, or makes more than one of.
_SPECIAL = "[Σİ]"


def word_lists(texts: pa.Array) -> pa.ListArray:
    """words() of each text, of a null none, without a Python object for each word."""
    texts = pc.fill_null(texts, "")
    spaced = pc.utf8_trim_whitespace(pc.utf8_lower(pc.replace_substring_regex(texts, r"[^\p{L}]+", " ")))
    blank = pc.equal(spaced, "")
    lists = pc.if_else(blank, pa.scalar([], pa.list_(pa.string())), pc.utf8_split_whitespace(spaced))
    odd = np.flatnonzero(pc.match_substring_regex(texts, _SPECIAL).to_numpy(zero_copy_only=False))
    if len(odd):
        made = lists.to_pylist()
        for i in odd.tolist():
            made[i] = words(texts[i].as_py())
        lists = pa.array(made, pa.list_(pa.string()))
    return lists


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    """languages in order of name; frequent words, and by language their log frequencies with a zero behind them; counts (size, entry, n, by: array of counts by language) of all words, size 0, and n-grams; totals by size."""

    languages: list[str]
    words: pa.Array
    logs: np.ndarray
    counts: DataFrame | None
    totals: np.ndarray

    def log_column(self) -> Column:
        """The log frequencies by language of a row of counts."""
        every = F.element_at(F.array(*[F.lit(float(t.sum())) for t in self.totals]), F.col("size") + 1)
        own = F.element_at(F.array(*[F.array(*[F.lit(float(v)) for v in t]) for t in self.totals]), F.col("size") + 1)
        return F.zip_with("by", own, lambda n, total: F.ln((n + PRIOR * F.col("n") / every) / (total + PRIOR)))


def _logs(by: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.log((by + PRIOR * by.sum() / total.sum()) / (total + PRIOR))


class Scorer:
    """The method in one process, for small models: takes all counts to the driver."""

    def __init__(self, model: Model):
        self.m = model
        rows = model.counts.collect() if model.counts is not None else []
        self.tables = [{r["entry"]: _logs(np.array(r["by"], float), model.totals[size]) for r in rows if r["size"] == size} for size in range(LONGEST_GRAM + 1)]

    def word(self, word: str) -> np.ndarray:
        if word in self.tables[0]:
            return self.tables[0][word]
        for n in range(min(LONGEST_GRAM, len(word) + 2), 0, -1):
            if found := [self.tables[n][g] for g in grams(word, n) if g in self.tables[n]]:
                return np.mean(found, axis=0)
        return np.zeros(len(self.m.languages))

    def predict(self, text: str | None) -> tuple[str, float]:
        found = Counter(words(text or ""))
        if not found or not self.m.languages:
            return UNKNOWN, 0.0
        total = np.sum([self.word(w) * c for w, c in found.items()], axis=0)
        best = int(total.argmax())
        return self.m.languages[best], float(1 / np.exp((total - total[best]) / math.sqrt(found.total())).sum())


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts: of words as size 0, of the n-grams of long words as size n."""
    release()
    held: dict[str, Counter] = {}
    for b in batches:
        found, langs = word_lists(b.column(0)), b.column(1).dictionary_encode()
        whose = langs.indices.to_numpy()
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            every = pc.value_counts(found.filter(pa.array(whose == i)).flatten())
            own, words_, n = held.setdefault(lang, Counter()), every.field(0).to_pylist(), every.field(1).to_pylist()
            own.update(dict(zip(words_, n, strict=True)))
        if sum(map(len, held.values())) >= HELD:
            yield from _sent(held)
            held = {}
    yield from _sent(held)
    held = {}
    release(trim=True)


def _sent(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, counter in held.items():
        long = [w for w in counter if len(w) > WORD_CHARS]
        sizes: dict[int, Counter] = {}
        for w in long:
            _add_grams(sizes, w, counter.pop(w))
        yield from _batches(lang, {0: counter} | sizes)


def _add_grams(sizes: dict[int, dict], word: str, weight: int) -> None:
    for n in range(1, LONGEST_GRAM + 1):
        own = sizes.setdefault(n, {})
        get = own.get
        for g in grams(word, n):
            own[g] = get(g, 0) + weight


def _batches(lang: str, sizes: dict[int, dict]) -> Iterator[pa.RecordBatch]:
    for size, counter in sizes.items():
        n = len(counter)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array([size] * n, pa.int32()), pa.array(list(counter), pa.string()), pa.array(list(counter.values()), pa.int64())], names=["lang", "size", "entry", "n"])


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of the n-grams of counted words."""
    held: dict[str, dict[int, dict]] = {}
    for b in batches:
        for word, lang, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            _add_grams(held.setdefault(lang, {}), word, n)
        if sum(len(c) for sizes in held.values() for c in sizes.values()) >= HELD:
            for lang, sizes in held.items():
                yield from _batches(lang, sizes)
            held = {}
    for lang, sizes in held.items():
        yield from _batches(lang, sizes)
    held = {}
    release(trim=True)


_PARTIAL = "lang string, size int, entry string, n bigint"


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = CELLS) -> Model:
    """Counts over all rows, in a table; the driver gets the most frequent words, at most max_words and CELLS by the languages, and totals."""
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    every = written(rows.mapInArrow(_counts, _PARTIAL).groupBy("size", "entry", "lang").agg(F.sum("n").alias("n")), "words")
    of_words = every.filter("size = 0").select(F.col("entry").alias("word"), "lang", "n").mapInArrow(_gram_counts, _PARTIAL)
    parts = every.select(*[c.split()[0] for c in _PARTIAL.split(", ")]).unionByName(of_words)
    totals = {(r["size"], r["lang"]): r["n"] for r in every.groupBy("size", "lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted({lang for _, lang in totals})
    if not languages:
        return Model([], pa.array([], pa.string()), np.zeros((0, 1)), None, np.zeros((LONGEST_GRAM + 1, 0)))
    by = F.array(*[F.coalesce(F.sum(F.when(F.col("lang") == lang, F.col("n"))), F.lit(0)) for lang in languages])
    counts = written(parts.groupBy("size", "entry").agg(F.sum("n").alias("n"), by.alias("by")), "counts")
    sums = {r["size"]: r["by"] for r in counts.groupBy("size").agg(F.array(*[F.sum(F.get("by", F.lit(i))) for i in range(len(languages))]).alias("by")).collect()}
    total = np.array([sums.get(size, [0] * len(languages)) for size in range(LONGEST_GRAM + 1)], float)
    own, most = counts.filter("size = 0"), min(max_words, CELLS // len(languages))
    frequent = own.filter(F.col("n") >= (frequent_floor(own, "n", most) if most else 1 << 62)).select("entry", *[F.get("by", F.lit(i)).alias(f"n{i}") for i in range(len(languages))]).toArrow()
    n = np.array([frequent.column(f"n{i}").to_numpy() for i in range(len(languages))], float)
    logs = np.log((n + PRIOR * n.sum(0) / total[0].sum()) / (total[0] + PRIOR)[:, None])
    return Model(languages, frequent.column("entry").combine_chunks(), np.hstack([logs, np.zeros((len(languages), 1))]), counts, total)


_SUMMED = "total array<double>, words int, others map<string, int>"


def _summed(text: Column, model: Model, spark) -> Column:
    """Struct (total, words, others) of a text: the sum over frequent words, the number of words, and the other words with their counts."""
    shared, together = spark.sparkContext.broadcast((model.words, model.logs)), TOGETHER

    @F.arrow_udf(_SUMMED)
    def summed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table, logs = shared.value
        for texts in batches:
            parts = [_looked_up(word_lists(run), table, logs) for run in _runs(texts, together)]
            yield pa.concat_arrays(parts) if parts else pa.array([], _SUMMED_TYPE)
            del parts
        release(trim=True)

    return summed(text)


_SUMMED_TYPE = pa.struct([("total", pa.list_(pa.float64())), ("words", pa.int32()), ("others", pa.map_(pa.string(), pa.int32()))])


def _runs(texts: pa.Array, together: int) -> Iterator[pa.Array]:
    """Texts in runs of about so many bytes, each text whole."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
    at = 0
    while at < len(texts):
        before = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + together, "right")))
        yield texts.slice(at, end - at)
        at = end


def _looked_up(texts: pa.ListArray, table: pa.Array, logs: np.ndarray) -> pa.Array:
    sizes, flat = pc.list_value_length(texts).to_numpy().astype(np.int64), texts.flatten()
    last = logs.shape[1] - 1
    rows = pc.fill_null(pc.index_in(flat, value_set=table), last).to_numpy()
    some = sizes > 0
    starts = (np.cumsum(sizes) - sizes)[some]
    totals = np.zeros((len(texts), len(logs)))
    for i, own in enumerate(logs):
        if len(flat):
            totals[some, i] = np.add.reduceat(own[rows], starts)
    others: list[dict] = [{} for _ in range(len(texts))]
    unknown = np.flatnonzero(rows == last)
    owner = np.searchsorted(np.cumsum(sizes), unknown, "right")
    for word, text in zip(flat.take(pa.array(unknown)).to_pylist(), owner.tolist(), strict=True):
        own = others[text]
        own[word] = own.get(word, 0) + 1
    return pa.StructArray.from_arrays([pa.array(list(totals), pa.list_(pa.float64())), pa.array(sizes, pa.int32()), pa.array([list(o.items()) for o in others], _SUMMED_TYPE.field("others").type)], ["total", "words", "others"])


def _word_logs(words_: DataFrame, model: Model) -> DataFrame:
    """(word, logs) of different words: a known one's own logs, else the mean of its longest known n-grams; words without any are left out.

    Shorter n-grams are cut only from words of which no longer one is known, and those are few.
    """
    logs = model.log_column().alias("logs")
    known = model.counts.filter("size = 0").select(F.col("entry").alias("word"), logs)
    joined = written(words_.join(known, "word", "left"), "word_logs")
    found, left = joined.filter("logs IS NOT NULL"), joined.filter("logs IS NULL").select("word")
    mean = F.array(*[F.avg(F.get("logs", F.lit(i))) for i in range(len(model.languages))])
    for n in range(LONGEST_GRAM, 0, -1):
        table = model.counts.filter(F.col("size") == n).select("entry", logs)
        own = written(left.select("word", F.explode(_gram_column(F.col("word"), n)).alias("entry")).join(table, "entry").groupBy("word").agg(mean.alias("logs")), "backed_off")
        found, left = found.unionByName(own), left.join(own.select("word"), "word", "left_anti")
    return found


def _gram_column(word: Column, n: int) -> Column:
    """The n-grams that grams() gives."""
    whole = word if n == 1 else F.concat(F.lit("<"), word, F.lit(">"))
    starts = F.when(F.length(whole) >= n, F.sequence(F.lit(1), F.length(whole) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substring(whole, i, F.lit(n)))


@dataclass
class Predicted:
    """rows: the documents as a table with a key of its own; found: (key, lang_pred, score), a row for each."""

    rows: DataFrame
    found: DataFrame
    key: str


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True) -> Predicted:
    """Documents with keys, and their predictions beside them; only keys and numbers are shuffled, never texts."""
    spark, L = docs.sparkSession, len(model.languages)
    key, sums = free_name(docs, "text_key"), free_name(docs, "sums")
    if not L:
        rows = written(docs.withColumn(key, F.monotonically_increasing_id()), "texts")
        return Predicted(rows if keep_text else rows.drop(text_col), rows.select(key, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")), key)
    table = docs.withColumn(key, F.monotonically_increasing_id()).withColumn(sums, _summed(F.col(text_col), model, spark))
    # Keys hold for good once they are written.
    table = written(table if keep_text else table.drop(text_col), "texts")
    base = table.select(F.col(key).alias("key"), F.col(sums)["total"].alias("total"), F.col(sums)["words"].alias("words"))
    sent = table.select(F.col(key).alias("key"), F.explode(F.col(sums)["others"]).alias("word", "c"))
    each = written(sent.groupBy("word").agg(F.count("*").alias("texts")), "others")
    logs = written(_word_logs(each.select("word"), model).join(each, "word"), "other_logs")
    floor = frequent_floor(logs, "texts", HOT)
    weighed = lambda rows: rows.select("key", *[(F.get("logs", F.lit(i)) * F.col("c")).alias(f"v{i}") for i in range(L)])
    hot = logs.filter(F.col("texts") >= floor).select("word", "logs")
    often = sent.join(F.broadcast(hot), "word")
    seldom = sent.join(F.broadcast(hot.select("word")), "word", "left_anti").join(logs.filter(F.col("texts") < floor).select("word", "logs"), "word")
    first = base.select("key", *[F.get("total", F.lit(i)).alias(f"v{i}") for i in range(L)], "words")
    others = weighed(often).unionByName(weighed(seldom)).withColumn("words", F.lit(None).cast("int"))
    total = first.unionByName(others).groupBy("key").agg(F.array(*[F.sum(f"v{i}") for i in range(L)]).alias("total"), F.max("words").alias("words"))
    # array_position takes the first of equal sums, so ties go by name.
    best = F.array_max("total")
    share = 1 / F.aggregate(F.transform("total", lambda t: F.exp((t - best) / F.sqrt("words"))), F.lit(0.0), lambda a, v: a + v)
    name = F.element_at(F.array(*map(F.lit, model.languages)), F.array_position("total", best).cast("int"))
    blank = F.col("words") == 0
    found = total.select(F.col("key").alias(key), F.when(blank, UNKNOWN).otherwise(name).alias("lang_pred"), F.when(blank, 0.0).otherwise(share).alias("score"))
    return Predicted(table.drop(sums), found, key)


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """docs, with keep_text=False without their texts, with lang_pred and score; columns of these names are replaced, all others stay."""
    found = predict(docs.drop(*[c for c in docs.columns if c.lower() in ("lang_pred", "score")]), model, text_col, keep_text)
    return found.rows.join(found.found, found.key).drop(found.key)


def keep(docs: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The docs of one known language with a score of ``least`` or more.

    No copy of the texts is made: those that are rejected are found again in docs by hashes. Texts are shuffled only if too many are rejected for a broadcast of their hashes.
    """
    found = predict(docs.select(F.col(text_col).alias("text"), text_key(F.col(text_col)).alias("hashes")), model, "text", keep_text=False)
    bad = found.found.filter((F.col("lang_pred") == UNKNOWN) | (F.col("score") < least)).select(found.key)
    name = free_name(docs, "rejected")
    out = written(found.rows.join(bad, found.key).select(F.col("hashes").alias(name)).distinct(), "rejected")
    return docs.join(out, text_key(docs[text_col]) == out[name], "left_anti")
