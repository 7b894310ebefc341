"""Quality by a sparse ensemble of rules over text statistics.

``statistics`` are native columns of a text: sizes, shares of kinds of characters, words and lines. A random forest of shallow trees
(Spark ML, grown on all labelled rows) proposes splits; every path from a root to one of its nodes is a rule, a conjunction of
bounds on statistics, with the tightest bounds kept and equal rules merged. A lasso logistic regression over the rules' truth values, also fitted by Spark ML,
leaves most weights at zero; what remains is compiled into one column expression, so scoring is part of any Spark plan, needs no Python
and no model object in the workers, and can be read (``describe``).

Statistics are computed once for each text; texts themselves are neither shuffled nor joined. Labels meet statistics, a few
dozen numbers a row, by id. The driver gets the trees and the weights, whose number the parameters bound (``TREES``, ``DEPTH``).

Defined results: null texts are as empty ones (all statistics 0) and get a score; rows without a label don't teach; labels of an id that
occurs several times, on either side, teach once for each pair; where all labels agree the score is the share of label 1, without
any label 0.5; rows that repeat score alike; an empty table gives no rows; columns named as the results are replaced, all others stay.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspar.llm.common import free_name, written

TREES, DEPTH, BINS, SEED = 24, 3, 64, 7
#: The lasso's weight, as a share of the mean log loss.
PENALTY = 0.001
_WORD_END = r"[\s]+"

#: The statistics, in order. Shares are 0 where there is nothing to share.
STATISTICS = [
    "log_chars", "log_words", "log_lines", "letters", "capitals", "digits", "spaces", "stops", "shouts", "other",
    "word_chars", "words_unlike", "words_single", "words_again", "words_lettered", "lines_unlike", "line_words",
]


def _share(part: Column, of: Column) -> Column:
    return F.when(of > 0, part / of).otherwise(0.0)


def _without(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def statistics(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """docs without the text, with a struct of STATISTICS under name."""
    own = {part: free_name(docs, f"own_{part}") for part in ("text", "words", "lines", "letters", "marks")}
    # Columns of their own, each used several times: Spark computes such ones once, where it would unfold fields of a struct.
    held = docs.withColumn(own["text"], F.coalesce(F.col(text_col), F.lit("")))
    t, w, x, letters, marks = (F.col(c) for c in own.values())
    held = held.withColumns({
        own["words"]: F.filter(F.split(t, _WORD_END), lambda v: v != ""), own["lines"]: F.filter(F.split(t, "\n"), lambda v: v != ""),
        own["letters"]: _without(t, r"[^\p{L}]+"), own["marks"]: _without(t, r"[\p{L}\p{Nd}\s]+"),
    })
    counted = {
        "chars": F.length(t), "words": F.size(w), "lines": F.size(x), "letters": F.length(letters), "capitals": F.length(_without(letters, r"[^\p{Lu}]+")), "digits": F.length(_without(t, r"[^0-9]+")),
        "marks": F.length(marks), "stops": F.length(marks) - F.length(F.translate(marks, ".,;:!?'\"-", "")), "shouts": F.length(marks) - F.length(F.translate(marks, "!?", "")),
        "unlike": F.size(F.array_distinct(w)), "single": F.size(F.filter(w, lambda v: F.length(v) == 1)), "lettered": F.size(F.filter(w, lambda v: v.rlike(r"^[\p{L}]+[.,;:!?]?$"))),
        "again": F.size(F.filter(F.arrays_zip(F.slice(w, 2, F.greatest(F.size(w), F.lit(1))).alias("a"), w.alias("b")), lambda p: p["a"] == p["b"])), "lines_unlike": F.size(F.array_distinct(x)),
    }
    names = {n: free_name(docs, f"own_n_{n}") for n in counted}
    held = held.withColumns({names[n]: c.cast("double") for n, c in counted.items()})
    c = {n: F.col(names[n]) for n in counted}
    spaces = c["chars"] - c["letters"] - c["marks"] - c["digits"]
    made = {
        "log_chars": F.log1p(c["chars"]), "log_words": F.log1p(c["words"]), "log_lines": F.log1p(c["lines"]), "letters": _share(c["letters"], c["chars"]), "capitals": _share(c["capitals"], c["letters"]),
        "digits": _share(c["digits"], c["chars"]), "spaces": _share(spaces, c["chars"]), "stops": _share(c["stops"], c["chars"]), "shouts": _share(c["shouts"], c["chars"]),
        "other": _share(c["marks"] - c["stops"], c["chars"]), "word_chars": _share(c["chars"] - spaces, c["words"]), "words_unlike": _share(c["unlike"], c["words"]), "words_single": _share(c["single"], c["words"]),
        "words_again": _share(c["again"], c["words"]), "words_lettered": _share(c["lettered"], c["words"]), "lines_unlike": _share(c["lines_unlike"], c["lines"]), "line_words": _share(c["words"], c["lines"]),
    }
    return held.withColumn(name, F.struct(*[made[s].alias(s) for s in STATISTICS])).drop(*own.values(), *names.values(), text_col)


@dataclass(frozen=True, order=True)
class Rule:
    """A conjunction: each statistic (by number) above ``low`` and at or below ``high``."""

    bounds: tuple[tuple[int, float, float], ...]

    def column(self, stats: str) -> Column:
        tests = [t for at, low, high in self.bounds for t in ((F.col(stats)[STATISTICS[at]] > F.lit(low)) if low > -math.inf else None, (F.col(stats)[STATISTICS[at]] <= F.lit(high)) if high < math.inf else None) if t is not None]
        return F.when(reduce(lambda a, b: a & b, tests), 1.0).otherwise(0.0)

    def __str__(self) -> str:
        said = []
        for at, low, high in self.bounds:
            said.append(STATISTICS[at] + (f" > {low:.4g}" if low > -math.inf else "") + (f" <= {high:.4g}" if high < math.inf else ""))
        return " and ".join(said)


@dataclass
class Ensemble:
    """The rules whose weights the lasso left, and the intercept; without any rule the score is ``share``."""

    rules: list[Rule] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    intercept: float = 0.0
    share: float = 0.5
    proposed: int = 0

    def score(self, stats: str) -> Column:
        if not self.rules:
            return F.lit(self.share)
        return 1.0 / (1.0 + F.exp(-reduce(add, [F.lit(self.intercept)] + [r.column(stats) * F.lit(w) for r, w in zip(self.rules, self.weights, strict=True)])))

    def describe(self) -> list[tuple[float, str]]:
        """Weights and rules, the largest first."""
        return sorted(((w, str(r)) for r, w in zip(self.rules, self.weights, strict=True)), key=lambda p: (-abs(p[0]), p[1]))


def tree_rules(root) -> set[Rule]:
    """The rules of all nodes of a tree but its root, from the JVM's nodes."""
    found: set[Rule] = set()
    held = [(root, {})]
    while held:
        node, bounds = held.pop()
        if bounds:
            found.add(Rule(tuple(sorted((at, low, high) for at, (low, high) in bounds.items()))))
        if node.subtreeDepth() == 0:
            continue
        split = node.split()
        at, cut = split.featureIndex(), split.threshold()
        low, high = bounds.get(at, (-math.inf, math.inf))
        held.append((node.leftChild(), bounds | {at: (low, min(high, cut))}))
        held.append((node.rightChild(), bounds | {at: (max(low, cut), high)}))
    return found


def train(labelled: DataFrame, stats: str = "stats", label: str = "label", trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> Ensemble:
    """Fits all rows of labelled, a struct of statistics and a label of 0 or 1; rows of no label are left out."""
    vector = labelled.filter(F.col(label).isin(0, 1)).select(F.col(label).cast("double").alias("label"), *[F.col(stats)[s].alias(s) for s in STATISTICS])
    rows = written(VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(vector).select("label", "features", F.struct(*STATISTICS).alias("stats")), "labelled")
    seen = rows.agg(F.count("*").alias("n"), F.sum("label").alias("ones")).first()
    if not seen["n"]:
        return Ensemble()
    share = seen["ones"] / seen["n"]
    if share in (0.0, 1.0):
        return Ensemble(share=share)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=BINS, seed=SEED, featureSubsetStrategy="onethird", bootstrap=False).fit(rows)
    rules = sorted(set().union(*[tree_rules(t._call_java("rootNode")) for t in forest.trees]))
    if not rules:
        return Ensemble(share=share)
    truths = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(rows.select("label", *[r.column("stats").alias(f"r{i}") for i, r in enumerate(rules)]))
    # Rules are all in 0 and 1: standardizing would let rare ones weigh more.
    fitted = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=100, standardization=False).fit(written(truths.select("label", "features"), "truths"))
    kept = [(r, float(w)) for r, w in zip(rules, fitted.coefficients.toArray(), strict=True) if w]
    if not kept:
        return Ensemble(share=share, proposed=len(rules))
    return Ensemble([r for r, _ in kept], [w for _, w in kept], float(fitted.intercept), share, len(rules))


def quality(docs: DataFrame, labels: DataFrame, teaches: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **settings) -> tuple[DataFrame, Ensemble]:
    """docs, without their text, with ``stats`` and ``score``; labels of rows that don't satisfy ``teaches`` (over the columns of docs) are never looked at.

    The first element is a table read back, so that texts are gone through once.
    """
    stats = free_name(docs, "stats")
    taught = free_name(docs, "taught")
    table = written(statistics(docs.withColumn(taught, F.coalesce(teaches, F.lit(False))), text_col, stats), "statistics")
    label = labels.select(F.col(id_col).alias("_labelled_id"), F.col(label_col).alias("label"))
    pairs = table.filter(F.col(taught)).select(F.col(id_col).alias("_id"), F.col(stats).alias("stats")).join(label, F.col("_id") == F.col("_labelled_id")).select("stats", "label")
    model = train(pairs, **settings)
    kept = [f"`{c}`" for c in table.columns if c not in (stats, taught) and c.lower() not in ("stats", "score")]
    return table.select(*kept, F.col(stats).alias("stats"), model.score(stats).alias("score")), model
