"""Sharding, language ID, token files, BPE and language-model scores."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from inkspar.llm import bpe, langid, lm, queries_text, registry, sharding, tokens

RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")


def placed(df, **options):
    return [r.asDict() for r in sharding.assign(df, **options).collect()]


def test_sharding_odd_rows(odd, none, spark):
    rows = placed(odd.withColumn("shard", F.lit(5)).withColumn("block", F.lit(1)))
    assert len(rows) == odd.count() and placed(none) == []
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in ((r["doc_id"], r["text"]) for r in odd.collect()))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    for shard in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    with pytest.raises(ValueError):
        sharding.shard_of(F.lit("a"), sharding.Node("r", (sharding.Node("a", (), 0), sharding.Node("b", (sharding.Node("c", (), 1),)))))


def test_sharding_balance_and_movement(spark):
    df = spark.range(24_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    rows = placed(df)
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(24)) and max(counts.values()) < 1200 and min(counts.values()) > 800
    moved = [r for r in rows if r["grown_shard"] != r["shard"]]
    assert all(r["grown_shard"] == 24 for r in moved) and 700 < len(moved) < 1250
    # a heavier rack: rows move into its subtree only, and within other racks nothing moves
    light, heavy = sharding.tree(1, 2, 2), sharding.tree(1, 2, 2)
    rack = heavy.children[0].children[1]
    more = sharding.Node("root", (sharding.Node("r0", (heavy.children[0].children[0], sharding.Node(rack.name, (*rack.children, sharding.Node("shard9", (), 9))))),))
    both = df.select(sharding.shard_of(F.col("doc_id").cast("string"), light).alias("a"), sharding.shard_of(F.col("doc_id").cast("string"), more).alias("b")).groupBy("a", "b").count().collect()
    assert all(r["b"] in (2, 3, 9) for r in both if r["a"] != r["b"])


def test_sharding_against_python(odd, spark):
    """Each draw, made again in Python."""
    import xxhash

    def xx(values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest(v.encode(), seed)
        return seed

    def descend(key, node):
        while node.children:
            node = min(node.children, key=lambda c: -math.log(((xx([key, c.name]) >> 12) + 0.5) / 2**52) / c.weight)
        return node.shard

    for r in placed(spark.range(300).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))):
        assert r["shard"] == descend(str(r["doc_id"]), sharding.tree())


def test_write_shards(odd, spark, tmp_path):
    sharding.write_shards(odd, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == odd.count()


def test_language_odd_rows(odd, none, spark):
    model = langid.train(odd)
    assert model.languages == ["de", "en", "fr"]
    clash = odd.withColumn("lang_pred", F.lit(1)).withColumn("score", F.lit("x"))
    found = langid.identify(clash, model).collect()
    assert len(found) == odd.count() and all(0 <= r["score"] <= 1 for r in found)
    by = {r["doc_id"]: r["lang_pred"] for r in found}
    assert {by[i] for i in (4, 5, 6, 7)} == {"und"} and by[1] == "en" and by[3] == "fr" and by[-3] == "de" and by[None] == "de" and by[8] == "en"
    assert {r["score"] for r in found if r["lang_pred"] == "und"} == {0.0}
    empty = langid.train(none)
    assert empty.languages == [] and {r["lang_pred"] for r in langid.identify(odd, empty).collect()} == {"und"}
    assert langid.identify(none, model).count() == 0


def test_language_counts_and_backoff(spark):
    df = spark.createDataFrame([("aa aa bb", "x"), ("aa", "x"), ("cc", "y")], "text string, lang string")
    model = langid.train(df)
    row = model.logs[:, model.words.to_pylist().index("aa")]
    assert row[0] == pytest.approx(math.log((3 + 10 * 3 / 5) / 14), rel=1e-5) and row[1] == pytest.approx(math.log((10 * 3 / 5) / 11), rel=1e-5)
    scorer = langid.Scorer(model)
    assert scorer.predict("cca")[0] == "y" and scorer.predict("zz") == ("x", 0.5) and scorer.predict("aab")[0] == "x"
    assert langid.train(df, max_words=1).words.to_pylist() == ["aa"] and not len(langid.train(df, max_words=0).words)


@pytest.mark.parametrize(("hot", "together"), [(0, 1), (3, 500), (5_000, 1_000_000)])
def test_language_model_size_changes_no_result(odd, real, spark, monkeypatch, hot, together):
    """With no word, some or all words in the workers, and with few or many words met by a broadcast, predictions are the same, and those of the method in one process."""
    monkeypatch.setattr(langid, "HOT", hot)
    monkeypatch.setattr(langid, "TOGETHER", together)
    labelled = real.filter("doc_id % 4 != 2").unionByName(odd.filter("doc_id <> 8"))
    asked = real.unionByName(odd).unionByName(spark.createDataFrame([(500 + i, t, None, None, 0) for i, t in enumerate(["日本語日本語", "qqzzx the", "½", "the " * 300 + "zzyq", "中文" * 40, "über straße", "qq qq qq"])], real.schema))
    found = []
    for most in (0, 40, 1 << 30):
        model = langid.train(labelled, max_words=most)
        assert len(model.words) <= most
        found.append({(str(r["doc_id"]), r["text"]): (r["lang_pred"], r["score"]) for r in langid.identify(asked, model).collect()})
    scorer = langid.Scorer(model)
    for k in found[0]:
        want = scorer.predict(k[1])
        assert {f[k][0] for f in found} == {want[0]} and all(f[k][1] == pytest.approx(want[1], rel=1e-9, abs=1e-12) for f in found), k
    assert len(found[0]) > 200


def brute_predict(rows, text):
    """Language and score by plain dictionaries, with all words and n-grams in the model."""
    def cut(t):
        out = "".join(c if c.isalpha() else " " for c in t.lower()).split()
        return out

    counts = {}
    for t, lang in rows:
        if t is None or lang is None:
            continue
        for w in cut(t):
            if len(w) <= langid.WORD_CHARS:
                counts.setdefault((0, lang), Counter())[w] += 1
            for n in range(1, 5):
                marked = w if n == 1 else f"<{w}>"
                for i in range(len(marked) - n + 1):
                    counts.setdefault((n, lang), Counter())[marked[i : i + n]] += 1
    langs = sorted({lang for _, lang in counts})
    total = {k: c.total() for k, c in counts.items()}

    def log(n, x, lang):
        every, all_ = sum(counts.get((n, o), {}).get(x, 0) for o in langs), sum(total.get((n, o), 0) for o in langs)
        return math.log((counts.get((n, lang), {}).get(x, 0) + langid.PRIOR * every / all_) / (total.get((n, lang), 0) + langid.PRIOR))

    found = cut(text or "")
    if not found:
        return "und", 0.0
    sums = dict.fromkeys(langs, 0.0)
    for w in found:
        entries = [(0, w)] if any(w in counts.get((0, o), {}) for o in langs) else []
        for n in range(min(4, len(w) + 2), 0, -1):
            if entries:
                break
            marked = w if n == 1 else f"<{w}>"
            entries = [(n, marked[i : i + n]) for i in range(len(marked) - n + 1) if any(marked[i : i + n] in counts.get((n, o), {}) for o in langs)]
        for lang in langs:
            sums[lang] += sum(log(n, x, lang) for n, x in entries) / max(1, len(entries))
    best = max(langs, key=lambda x: sums[x])
    return best, 1 / sum(math.exp((v - sums[best]) / math.sqrt(len(found))) for v in sums.values())


def test_language_against_brute_force(odd, real, spark):
    unspaced = spark.createDataFrame([(100, "日本語" * 30 + "。" + "中文" * 25, "ja"), (101, "สวัสดีชาวโลก" * 9, "th"), (102, "ສະບາຍດີ" * 12, "lo")], "doc_id long, text string, lang string")
    labelled = real.filter("doc_id % 4 != 2").select("doc_id", "text", "lang").unionByName(odd.filter("length(text) < 1000").select("doc_id", "text", "lang")).unionByName(unspaced)
    scorer = langid.Scorer(langid.train(labelled))
    rows = [(r["text"], r["lang"]) for r in labelled.collect()]
    asked = [r["text"] for r in real.filter("doc_id % 4 = 2 AND length(text) < 3000").limit(12).collect()] + ["日本語日本語", "qqzzx the", "ชาวโลก", "½", "①②③", "Ⅷ x²", "", None, "a1b_c", "中文" * 40]
    for t in asked:
        lang, score = scorer.predict(t)
        want, wanted = brute_predict(rows, t)
        assert lang == want and score == pytest.approx(wanted, rel=2e-3, abs=1e-6), t
    assert brute_predict(rows, "①②③")[0] == "und" and brute_predict(rows, "日本語日本語")[0] == "ja"


def test_language_words_are_letters():
    assert langid.words("Ab½c ①②③ Ⅷ 12 x_y É日2本 ²") == ["ab", "c", "x", "y", "é日", "本"]


def test_language_word_lists(real):
    import pyarrow as pa

    texts = [r["text"] for r in real.limit(150).collect()] + [None, "", "  ", "12 _", "ΑΣ ΟΔΟΣ, Σ", "İstanbul İ x", "É日2本", "a", "ÀÉ ẞ ǅ ⅷ ª º ß", "नमस्ते", "日本語" * 9, "x\u00a0y\u2028z"]
    assert langid.word_lists(pa.array(texts, pa.string())).to_pylist() == [langid.words(t or "") for t in texts]
    assert langid.word_lists(pa.array([], pa.string())).to_pylist() == []


def test_language_held_out(spark, sf_dir):
    found = queries_text.op5_langid(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(found) > 20 and sum(r["lang_pred"] == r["lang"] for r in found) / len(found) > 0.97


def test_elias_fano():
    rng = np.random.default_rng(1)
    for values in ([], [0], [5], [0, 0, 0], list(range(1000)), np.cumsum(rng.integers(0, 900, 3000)).tolist(), [0, 2**50], sorted(rng.integers(0, 2**40, 700).tolist())):
        made = tokens.EliasFano.of(np.array(values, np.uint64))
        about, data = made.parts()
        back = tokens.EliasFano.read(about, data)
        assert [back.select(i) for i in range(len(values))] == list(values)
        with pytest.raises(IndexError):
            back.select(len(values))
    dense = tokens.EliasFano.of(np.cumsum(rng.integers(0, 900, 100_000)).astype(np.uint64)).parts()[1]
    assert len(dense) * 8 / 100_000 < 12


def expected_ids(text):
    t = Tokenizer.from_file(WORDS)
    return t.encode(text or "", add_special_tokens=False).ids + [2]


def test_token_files(odd, none, spark):
    for size in (tokens.FILE_IDS, 20):
        files = tokens.write(odd.withColumn("start", F.lit(1)), WORDS, 2, file_ids=size)
        got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in tokens.read(spark, files).collect())
        start, want = 0, []
        for doc_id, text in sorted(((r["doc_id"], r["text"]) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
            ids = expected_ids(text)
            want.append((start, doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        assert got == want and (size == 20) == (len(files) > 4)
    file = tokens.TokenFile(files[-1]["path"])
    for i, (doc_id, _, ids) in enumerate(file.documents(block=3)):
        assert file.doc_id(i) == doc_id and file.ids(i).tolist() == ids.tolist()
    assert tokens.write(none, WORDS, 2) == [] and tokens.read(spark, []).count() == 0
    with pytest.raises(ValueError):
        with open(files[0]["path"].removeprefix("file://") + "x", "wb") as f:
            f.write(b"no token file at all")
        tokens.TokenFile(files[0]["path"] + "x")


PIECES = ["a", "B", " ", "the", "'s", ".", ",", "\n", "̈", "T̈", "é", "İ", "日本", "1", "\x1c", "\x85", "　", "ß", "!", "?.", "ǅ", "<|endoftext|>", "<|StartOfText|>", "ΑΣ", "ﬁ", "½", "x.y", "😀", "\x00", "  ", "'ll"]


def test_chunk_encoder_is_the_library():
    """With the library's own settings: special tokens in a text are found."""
    encoder, rng = tokens.ChunkEncoder(WORDS), random.Random(2)
    library = Tokenizer.from_file(WORDS)
    made = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(15))) for _ in range(3000)]
    made += ["hello <|endoftext|> world", "A<|startoftext|>b", "<|ENDOFTEXT|> <|endOFtext|>", "x <|endoftext| > |", "<|endoftext|>" * 3]
    assert 49407 in library.encode(made[-5], add_special_tokens=False).ids
    got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.batch(made)]
    assert got == [library.encode(x, add_special_tokens=False).ids for x in made]


def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_bpe_is_tiktoken():
    ours, theirs, rng = bpe.encoder(RANKS, P.PATTERN), reference(), random.Random(4)
    made = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(25))) for _ in range(3000)] + ["a" * 50_000 + " " * 30_000 + "!?" * 9_000, ""]
    made += ["".join(rng.choice("abcehinrtsou") for _ in range(rng.randrange(60))) for _ in range(2000)]
    for x in made:
        ids = theirs.encode_ordinary(x)
        assert ours.encode(x) == ids and ours.ids_text(x) == " ".join(map(str, ids)) and ours.decode(ids) == x.encode()


def test_bpe_columns(odd, none):
    clash = odd.withColumn("ids", F.lit(1)).withColumn("decoded", F.lit("x"))
    rows = bpe.decode(bpe.encode(clash, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    theirs = reference()
    assert len(rows) == odd.count()
    for r in rows:
        assert r["ids"] == theirs.encode_ordinary(r["text"] or "") and r["n_tokens"] == len(r["ids"]) and bytes(r["decoded"]) == (r["text"] or "").encode()
    assert bpe.encode(none, RANKS, P.PATTERN).count() == 0


def test_bpe_query(spark, sf_dir, real, rows_of):
    theirs = reference()
    want = {i: (len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows_of(real) for x in [theirs.encode_ordinary(t)]}
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries_text.op8_bpe(spark, sf_dir).collect()} == want


def brute_base(rows):
    cut = [(i, t, zlib.crc32(str(i).encode()) % 10 == 0 if i is not None else False) for i, t in rows]
    tok = lambda t: (t or "").encode().lower().split() + [None]
    counts = Counter(w for _, t, out in cut if not out for w in tok(t))
    n, below = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
    return sorted(((i if i is not None else -99, out, len(tok(t)), sum(w in counts for w in tok(t)), n, round(math.fsum(math.log10((counts[w] + 0.1) / below) for w in tok(t)), 6)) for i, t, out in cut), key=str)


def scored(docs, **options):
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    docs = docs.select("doc_id", "text", held.alias("held_out"))
    model, words = lm.train(docs.filter("NOT held_out"), **options)
    return model, lm.score(docs, model, words).collect()


def brute_score(rows):
    """Each text's log probability by plain dictionaries: bigrams of whole words, their counts in classes of the same quantised value."""
    cut = [(i, (t or "").encode().lower().split(), zlib.crc32(str(i).encode()) % 10 == 0 if i is not None else False) for i, t in rows]
    train = [["", *map(bytes, w), ""] for _, w, out in cut if not out]
    single = Counter(x for w in train for x in w[1:])
    n, below = sum(single.values()), sum(single.values()) + 0.1 * (len(single) + 1)
    pairs = Counter(p for w in train for p in zip(w, w[1:]))

    def stands(c):
        q = 1 + math.floor(math.log(c) / math.log(lm.BASE) + 1e-9) if c else 0
        same = [x for x in range(1, 4 * c + 4) if 1 + math.floor(math.log(x) / math.log(lm.BASE) + 1e-9) == q]
        return (same[0] + same[-1]) / 2 if c else 0.0

    value = {c: stands(c) for c in {0, *pairs.values()}}
    behind = Counter()
    for (h, _), c in pairs.items():
        behind[h] += value[c]
    base = lambda w: (single[w] + 0.1) / below
    p = lambda h, w: (value[pairs[h, w]] + lm.MU * base(w)) / (behind[h] + lm.MU)
    assert all(p(h, w) <= 1 for h, w in pairs)
    return sorted(((i if i is not None else -99, math.fsum(math.log10(p(h, w)) for h, w in zip(["", *words], [*words, ""]))) for i, words, _ in cut)), single, behind, p


@pytest.mark.parametrize("options", [{}, {"dictionary": 5}, {"dictionary": 0}, {"max_bits": 64}])
def test_lm_against_brute_force(odd, real, rows_of, options):
    """Base scores and counts, and the model's scores, with a filter of so many hashes that nothing is found falsely; pairs that it has no room for count alike."""
    for docs in (odd, real):
        model, rows = scored(docs, hashes=28, **options)
        got = sorted(((r["doc_id"] if r["doc_id"] is not None else -99, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows), key=str)
        for a, b in zip(got, brute_base(rows_of(docs)), strict=True):
            assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-4)
        want, *_ = brute_score(rows_of(docs))
        assert sorted((r["doc_id"] if r["doc_id"] is not None else -99, r["score"]) for r in rows) == [(i, pytest.approx(x, abs=1e-4)) for i, x in want]
        assert (model.left_out is not None) == ("max_bits" in options)


def test_lm_probabilities_sum_to_one(real, rows_of):
    _, single, behind, p = brute_score(rows_of(real))
    unseen = 0.1 / (sum(single.values()) + 0.1 * (len(single) + 1))
    for h in ["", *[w for w, _ in single.most_common(3)], list(single)[-1]]:
        assert math.fsum(p(h, w) for w in single) + lm.MU * unseen / (behind[h] + lm.MU) == pytest.approx(1, abs=1e-9)


def test_lm_repeated_texts_score_below_one(spark):
    """No probability above 1, however often a pair occurs."""
    _, rows = scored(spark.createDataFrame([(i, "aa bb") for i in range(5000)], "doc_id long, text string"))
    assert max(r["score"] for r in rows) < 0 and len(rows) == 5000


def test_lm_empty_and_model_quality(none, real, spark):
    assert scored(none)[1] == []
    _, rows = scored(spark.createDataFrame([(0, "a b"), (30, None)], "doc_id long, text string"))
    assert len(rows) == 2
    untrained = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string").withColumn("held_out", F.lit(True))
    assert [r["score"] for r in lm.score(untrained, *lm.train(untrained.limit(0))).collect()] == [0.0, 0.0]
    _, rows = scored(real)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out) + len(out)


def test_lm_hot_words_are_dealt_over_blocks(spark, monkeypatch, real, rows_of):
    monkeypatch.setattr(lm, "SPLIT", 40)
    model, rows = scored(real, hashes=28)
    assert model.blocks.split.max() > 3 and len(model.blocks.hot) > 20
    want, *_ = brute_score(rows_of(real))
    assert sorted((r["doc_id"], r["score"]) for r in rows) == [(i, pytest.approx(x, abs=1e-4)) for i, x in want]


def test_log_bloom():
    rng = np.random.default_rng(5)
    keys, counts = rng.integers(0, 1 << 63, 4000, dtype=np.uint64), rng.integers(1, 5000, 4000)
    blocks = lm.Blocks(8, np.sort(keys[:5] >> np.uint64(32)), np.full(5, 3, np.uint64))
    q, block = lm.quantised(counts), blocks.of(keys)
    parts = [lm.block_bits(keys[block == b], q[block == b]) for b in range(8)]
    sizes = np.array([len(p) * 8 for p in parts])
    whole = lm.LogBloom(blocks, np.cumsum(sizes) - sizes, sizes, np.concatenate(parts))
    got = whole.get(keys)
    assert (got >= q).all() and (got == q).mean() > 0.95
    assert (whole.get(rng.integers(1 << 63, (1 << 64) - 1, 4000, dtype=np.uint64)) > 0).mean() < 0.05
    assert all(abs(lm.DOUBLED[lm.quantised(np.array([c]))[0]] / 2 - c) <= 0.25 * c for c in (1, 2, 3, 10, 1000, 10**6))


def test_registry():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
    assert set(registry.ORACLES) <= set(registry.QUERIES)
