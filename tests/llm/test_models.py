"""Whitening, quality rules and fill-in-middle."""

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from inkspar.llm import infill, queries_models, rules, whitening


# Whitening: against numpy's eigenvectors of the whole covariance.

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_whitening(vectors, k=8):
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    parts = n * x - s
    deviation = [int(v) for v in (parts * parts).sum(axis=1)]
    c = (parts / n).astype(float)
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return deviation, c @ u / np.sqrt(e), e / np.trace(c.T @ c / n)


def same_up_to_sign(a, b, tolerance=1e-8):
    return all(min(np.abs(a[:, i] - b[:, i]).max(), np.abs(a[:, i] + b[:, i]).max()) < tolerance for i in range(b.shape[1]))


def test_whitening_query_against_numpy(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    deviation, whitened, explained = brute_whitening([r["embedding"] for r in rows])
    found = queries_models.op11_whitening(spark, sf_dir).orderBy("vec_id", "component").collect()
    assert len(found) == 8 * len(rows) and [r["component"] for r in found[:8]] == list(range(1, 9))
    assert [r["deviation"] for r in found[::8]] == deviation == [int(r["deviation_exact"]) for r in found[::8]]
    assert same_up_to_sign(np.array([r["whitened"] for r in found]).reshape(-1, 8), whitened)
    assert np.allclose([r["explained"] for r in found[:8]], explained, rtol=1e-10)
    assert {r["n"] for r in found} == {len(rows)} and max(r["identity_error"] for r in found) < 1e-10


@pytest.mark.parametrize("guard", [0, 4])
def test_lobpcg_takes_steps_where_a_block_is_narrow(spark, guard):
    """Dimension 60 with blocks of 4 and 8: the basis never holds the whole space, so steps must converge."""
    rng = np.random.default_rng(guard)
    turn, _ = np.linalg.qr(rng.standard_normal((60, 60)))
    vectors = (rng.standard_normal((700, 60)) * (1 + np.arange(60) / 30)) @ turn
    df = spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in enumerate(vectors)], VECTORS).repartition(7)
    out, fit = whitening.whiten(df, components=4, guard=guard)
    assert fit.passes > 8 and fit.residual <= whitening.TOLERANCE and fit.identity_error < 1e-9
    got = out.orderBy("vec_id").collect()
    deviation, whitened, _ = brute_whitening([r["embedding"] for r in got], 4)
    assert same_up_to_sign(np.array([r["whitened"] for r in got]), whitened) and [int(r["deviation"]) for r in got] == deviation
    with pytest.raises(RuntimeError):
        whitening.fit(df, components=4, guard=guard, steps=2)


def test_whitening_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None, 1), (2, [], 1), (3, [1.0, None, 2.0], 1), (4, [1.0, nan, 2.0], 1), (5, [inf, 0.0, 2.0], 1), (6, [1.0, 2.0], 1)]
    good = [(None, [0.5, -0.25, 3.0], None), (7, [0.5, 1.0, 0.0], 1), (7, [0.5, 1.0, 0.0], 1), (8, [1.5, -2.0, 0.125], 1), (9, [0.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame(bad + good, VECTORS).withColumn("whitened", F.lit("x")).withColumn("Deviation", F.lit(1)).withColumn("whitening_found", F.lit(2)).repartition(5)
    out, fit = whitening.whiten(df)
    assert out.columns == ["vec_id", "embedding", "label", "whitening_found", "deviation", "whitened"]
    got = sorted(out.collect(), key=lambda r: str((r["vec_id"], r["embedding"])))
    assert sorted(str(r["vec_id"]) for r in got) == sorted(str(r[0]) for r in good)
    deviation, whitened, explained = brute_whitening([r["embedding"] for r in got], 3)
    assert [int(r["deviation"]) for r in got] == deviation and same_up_to_sign(np.array([r["whitened"] for r in got]), whitened) and np.allclose(fit.explained, explained)
    alike, fit = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(3)], VECTORS))
    assert [(r["deviation"], r["whitened"]) for r in alike.collect()] == [(0, [])] * 3 and not len(fit.values)
    none, fit = whitening.whiten(spark.createDataFrame(bad[:5], VECTORS))
    assert none.count() == 0 and fit is None and none.columns[-2:] == whitening.RESULT


def test_whitening_leaves_out_directions_without_variance(spark):
    rng = np.random.default_rng(3)
    vectors = [[float(a), float(b), float(a + b), 0.0] for a, b in rng.integers(-50, 50, (40, 2))]
    out, fit = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], VECTORS))
    assert len(fit.values) == 2 and fit.identity_error < 1e-10 and all(len(r["whitened"]) == 2 for r in out.collect())


def test_whitening_entries_beyond_64_bits(spark):
    vectors = [[1e30, -1e30], [3e9, 1.0], [0.0, 5e9], [1.0, 2.0]]
    out, _ = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int"))
    x = [[max(-(1 << 46), min(1 << 46, math.floor(1024 * c))) + 100_000 for c in v] for v in vectors]
    s = [sum(col) for col in zip(*x, strict=True)]
    assert [int(r["deviation"]) for r in out.orderBy("vec_id").collect()] == [sum((4 * a - b) ** 2 for a, b in zip(v, s, strict=True)) for v in x]


# Quality.


def python_statistics(text):
    text = text or ""
    words, lines = [w for w in re.split(r"[ \t\n\x0b\f\r]+", text) if w], [x for x in text.split("\n") if x]
    letters = [c for c in text if c.isalpha()]
    marks = [c for c in text if not c.isalpha() and not c.isdigit() and c not in " \t\n\x0b\f\r"]
    digits = [c for c in text if c in "0123456789"]
    spaces = len(text) - len(letters) - len(marks) - len(digits)
    share = lambda a, b: a / b if b else 0.0
    stops = sum(c in ".,;:!?'\"-" for c in marks)
    return [
        math.log1p(len(text)), math.log1p(len(words)), math.log1p(len(lines)), share(len(letters), len(text)), share(sum(c.isupper() for c in letters), len(letters)), share(len(digits), len(text)), share(spaces, len(text)), share(stops, len(text)),
        share(sum(c in "!?" for c in marks), len(text)), share(len(marks) - stops, len(text)), share(len(text) - spaces, len(words)), share(len(set(words)), len(words)), share(sum(len(w) == 1 for w in words), len(words)),
        share(sum(a == b for a, b in zip(words, words[1:], strict=False)), len(words)), share(sum(re.fullmatch(r"[^\W\d_]+[.,;:!?]?", w) is not None for w in words), len(words)), share(len(set(lines)), len(lines)), share(len(words), len(lines)),
    ]


def test_statistics_against_python(odd, real, spark):
    for docs in (odd.filter("text IS NULL OR NOT text LIKE '%日%'"), real):
        found = rules.statistics(docs.withColumn("own_words", F.lit("x")).withColumn("copy", F.col("text")), "text", "stats").collect()
        assert "own_words" in found[0]
        for r in found:
            assert np.allclose([r["stats"][s] for s in rules.STATISTICS], python_statistics(r["copy"])), r["copy"]
    one = rules.statistics(spark.createDataFrame([("a a a\n\na 7!",)], "text string"), "text", "stats").first()["stats"]
    assert one["words_again"] == 3 / 5 and one["words_unlike"] == 2 / 5 and one["lines_unlike"] == 1.0 and one["digits"] == one["shouts"] == 1 / 11


def test_compiled_column_is_the_sum_of_its_rules(real):
    docs = real.select("doc_id", "text").withColumn("quality", (F.length("text") > 1000).cast("int"))
    scored, model = rules.quality(docs.select("doc_id", "text"), docs.select("doc_id", "quality"), F.lit(True))
    assert model.rules and model.proposed > len(model.rules) and all(model.weights) and len(set(model.rules)) == len(model.rules)
    wrong = 0
    for r in scored.collect():
        total = model.intercept
        for rule, weight in zip(model.rules, model.weights, strict=True):
            total += weight * all(low < r["stats"][at] <= high for at, low, high in rule.bounds)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)
        wrong += (r["score"] > 0.5) != (r["stats"]["log_chars"] > math.log1p(1000))
    assert wrong <= 0.03 * real.count()


def test_tree_paths_are_conjunctions():
    class Node:
        def __init__(self, at=None, cut=None, left=None, right=None):
            self.at, self.cut, self.left, self.right = at, cut, left, right

        def subtreeDepth(self):
            return 0 if self.at is None else 1 + max(self.left.subtreeDepth(), self.right.subtreeDepth())

        def split(self):
            return self

        featureIndex = lambda self: self.at
        threshold = lambda self: self.cut
        leftChild = lambda self: self.left
        rightChild = lambda self: self.right

    inf = math.inf
    tree = Node(3, 0.5, Node(), Node(3, 0.9, Node(1, 2.0, Node(), Node()), Node()))
    want = {((3, -inf, 0.5),), ((3, 0.5, inf),), ((3, 0.5, 0.9),), ((3, 0.9, inf),), ((1, -inf, 2.0), (3, 0.5, 0.9)), ((1, 2.0, inf), (3, 0.5, 0.9))}
    assert {r.bounds for r in rules.tree_rules(tree)} == want
    assert str(rules.Rule(((1, 2.0, inf), (3, 0.5, 0.9)))) == "log_words > 2 and letters > 0.5 <= 0.9"


def test_quality_held_out_and_blind(spark):
    """On held-out rows of the tables; labels of held-out rows, lang and source change nothing."""
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in queries_models.op12_quality(spark, sf).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(rows[i]["predicted"], q) for i, q in labels.items() if rows[i]["held_out"]]
    assert len(rows) == 1000 and len(held) > 50 and sum(p == q for p, q in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, None), (4, 0), (5, 0), (9, 1), (None, 1), (77, 1), (8, 5)], "doc_id long, quality int")
    clash = odd.withColumn("score", F.lit("x")).withColumn("stats", F.lit(1)).withColumn("taught", F.lit(2))
    scored, _ = rules.quality(clash, labels, F.lit(True))
    got = scored.collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got) and {"taught", "stats", "score"} <= set(scored.columns)
    assert len({r["score"] for r in got if r["doc_id"] == 9}) == 1
    alike, model = rules.quality(odd, labels.filter("quality = 1"), F.lit(True))
    assert not model.rules and {r["score"] for r in alike.collect()} == {1.0}
    untaught, _ = rules.quality(odd, labels, F.lit(False))
    assert {r["score"] for r in untaught.collect()} == {0.5}
    assert rules.quality(none, labels, F.lit(True))[0].count() == 0


# Fill-in-middle.


def brute_infill(doc_id, text, prefix="<P>", suffix="<S>", middle="<M>"):
    """By splitting the text, without offsets."""
    lines = text.split("\n")
    units = [x + "\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
    digits = hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()
    h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in (prefix, suffix, middle)):
        return len(units), "plain", None, None, text
    if h[3] % 100 < 50:
        return len(units), "spm", len(p), len(m), suffix + s + prefix + p + middle + m
    return len(units), "psm", len(p), len(m), prefix + p + suffix + s + middle + m


def test_infill_against_brute_force(spark, real):
    rng = random.Random(5)
    made = [(i, "".join(rng.choice(["\n", "<", "P>", "a", "é", "😀", "\r", " ", " "]) for _ in range(rng.randrange(30)))) for i in range(3000)]
    for docs in (spark.createDataFrame(made, "doc_id long, text string"), real.select("doc_id", "text")):
        out = infill.infill(docs).withColumn("back", infill.restored_column(F.col("form"), F.col("output"))).collect()
        for r in out:
            assert (r["units"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute_infill(r["doc_id"], r["text"])
            assert r["output_sha256"] == hashlib.sha256(r["output"].encode()).hexdigest() and r["back"]["text"] == r["text"] and r["back"]["sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
        assert {r["form"] for r in out} >= {"psm", "spm"}


def test_infill_odd_rows(odd, none, spark):
    clash = odd.withColumn("Output", F.lit(1)).withColumn("found", F.lit(2))
    out = infill.infill(clash)
    assert out.columns == [*odd.columns, "found", *infill.RESULT] and out.count() == odd.count()
    assert all(r["form"] == "plain" and r["units"] == 0 and r["output"] == "" for r in out.filter("text IS NULL OR text = ''").collect())
    assert infill.infill(none).count() == 0
    whole = infill.infill(odd, infill.Settings(percent=0)).collect()
    assert {r["form"] for r in whole} == {"plain"} and all(r["output"] == (r["text"] or "") for r in whole)
    law = infill.Settings(prefix="[fim_p]", suffix="[fim_s]", middle="[fim_m]", spm_percent=100, seed=1, unit=r"\w+")
    back = infill.infill(odd, law).withColumn("back", infill.restored_column(F.col("form"), F.col("output"), law)["text"]).collect()
    assert all(r["back"] == (r["text"] or "") for r in back) and "spm" in {r["form"] for r in back}
    for marks in (("", "b", "c"), ("a", "a", "c"), ("<P", "<PX", "x"), ("ab", "b", "c")):
        with pytest.raises(ValueError):
            infill.Settings(*marks)
    with pytest.raises(ValueError):
        infill.put_back(infill.Settings(), "psm", "no mark")


def test_infill_sql(spark, sf_dir, tmp_path):
    queries_models.op13_infill(spark, sf_dir).write.parquet(str(tmp_path / "o"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    con.sql(f"CREATE TEMP TABLE wanted AS {queries_models.ORACLES['op13_infill']}")
    ours = f"(SELECT * FROM '{tmp_path}/o/*.parquet')"
    assert con.sql("DESCRIBE wanted").fetchall() == con.sql(f"DESCRIBE SELECT * FROM {ours}").fetchall()
    assert con.sql(f"SELECT count(*) FROM ((FROM wanted EXCEPT ALL FROM {ours}) UNION ALL (FROM {ours} EXCEPT ALL FROM wanted))").fetchall() == [(0,)]
