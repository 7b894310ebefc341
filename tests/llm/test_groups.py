"""SimHash, SpotSigs, decontamination, WARC, chat and the pipeline."""

import gzip
import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from inkspar.llm import bpe, chat, decontaminate, jaccard, langid, queries_records, queries_text, simhash, spotsigs, warc
from inkspar.llm.components import components


def grouped(nodes, edges):
    """The least node of each node's component."""
    above = {n: n for n in nodes}

    def top(n):
        while above[n] != n:
            n = above[n]
        return n

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        above[b] = a
    return {n: top(n) for n in nodes}


def python_fingerprint(text):
    import xxhash

    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(rows):
    """(doc_id, component id) of each row; ids that are null only count where all are."""
    fps = sorted({f for _, f in rows})
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    root = grouped(range(len(fps)), pairs)
    at = {f: root[i] for i, f in enumerate(fps)}
    least = {}
    for i, f in rows:
        if i is not None:
            least[at[f]] = min(i, least.get(at[f], i))
    return sorted(((i, least.get(at[f])) for i, f in rows), key=str)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(rng.randrange(300, 420), rng.randrange(300, 420)) for _ in range(90)] + [(7, 7)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    assert found == grouped(nodes, [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("heavy", [1024, 3])
def test_simhash_links_against_brute_force(spark, heavy):
    rng = random.Random(heavy)
    made = set()
    for _ in range(25):
        base = rng.getrandbits(64)
        for _ in range(12):
            made.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))))
        for _ in range(12):
            made.add(base ^ sum(1 << b for b in rng.sample(range(32), rng.randrange(4))))
    made |= {0, 1, (1 << 64) - 1, (1 << 64) - 2, 1 << 63}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    values = sorted(map(signed, made))
    want = {(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    got = [tuple(r) for r in simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), heavy=heavy).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 4)


@pytest.mark.parametrize("large", [1, 3, 4096])
def test_members_of_large_and_small_components(spark, monkeypatch, large):
    monkeypatch.setattr(simhash, "LARGE", large)
    linked = [(i, 0) for i in range(40)] + [(i, 100) for i in range(100, 110)] + [(200, 200), (201, 200)]
    firsts = [(i, None if i == 7 else 1000 - i) for i, _ in linked] + [(300, 5), (301, None)]
    got = simhash.joined(spark.createDataFrame(firsts, "fp long, first_id long"), spark.createDataFrame(linked, "node long, root long")).collect()
    least = {r: min(1000 - i for i, q in linked if q == r and i != 7) for r in (0, 100, 200)}
    assert sorted(map(tuple, got), key=str) == sorted([(i, least[r], r) for i, r in linked] + [(300, 5, 300), (301, None, 301)], key=str)
    assert simhash.joined(spark.createDataFrame([], "fp long, first_id long"), spark.createDataFrame([], "node long, root long")).count() == 0


def test_simhash_rows(odd, none, real, rows_of):
    for docs in (odd, real):
        rows = rows_of(docs)
        mine = {t: python_fingerprint(t) for t in {t for _, t in rows if t is None or len(t) < 5000}}
        mine |= {t: simhash.fingerprint(t) for _, t in rows if t not in mine}
        found = simhash.near_duplicates(docs.withColumn("fp", F.lit("x")).withColumn("component_id", F.lit(0))).collect()
        assert sorted(((r["doc_id"], r["component_id"]) for r in found), key=str) == brute_components([(i, mine[t]) for i, t in rows])
        assert {r["fp"] & (2**64 - 1) for r in found} == set(mine.values())
        clash = docs.withColumn("kept_key", F.lit("x")).withColumn("__key", F.lit(1)).withColumn("bits", F.lit(2))
        kept = simhash.keep_one(clash)
        assert kept.columns == clash.columns
        assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(brute_kept(rows), key=str)
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0
    assert simhash.fingerprint("a B") == simhash.fingerprint(" A\tb") != simhash.fingerprint("a\x85b")


def brute_sets(text, size=5):
    """The set of shingles, as tuples of words."""
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute_kept(rows):
    """The smallest id of each group of texts linked by a Jaccard similarity of 0.8 of five-word shingles, compared all with all."""
    of = {t: brute_sets(t) for t in {t for _, t in rows}}
    sets = list(set(of.values()))
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if min(len(sets[i]), len(sets[j])) >= 0.8 * max(len(sets[i]), len(sets[j])) and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    root, at = grouped(range(len(sets)), pairs), {x: i for i, x in enumerate(sets)}
    least = {}
    for i, t in rows:
        r = root[at[of[t]]]
        least[r] = i if least.get(r) is None else min(least[r], i if i is not None else least[r])
    return list(least.values())


def python_signatures(text):
    """The set, without hashes."""
    import regex

    anchors = set(spotsigs.ANCHORS.split())
    words = regex.findall(r"[\p{L}\p{N}\p{M}]+", text.lower())
    runs, held = [], []
    for i, w in enumerate(words):
        if w in anchors and i + 1 < len(words):
            held.append(w)
        else:
            runs.append((tuple(held), w))
            held = []
    out = set()
    for i in range(len(runs) - 1):
        near = any(runs[j][0] for j in range(max(0, i - spotsigs.STRETCH + 1), i))
        if runs[i][0] or not near:
            out.add((*runs[i][0], runs[i][1], "|", runs[i + 1][1]))
    return out or {("whole", *words)}


def test_spotsigs_against_brute_force(odd, none, real, spark):
    for docs in (odd, real):
        plain = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
        found = spotsigs.compare_edited(docs.withColumn("signatures", F.lit(1)).withColumn("edited", F.lit(1))).collect()
        assert len(found) == len(plain)
        sets = {t: python_signatures(t) for _, t in plain}
        for r in found:
            assert len(r["signatures"]) == len(sets[r["text"]])
            third = len(r["text"]) // 3
            options = [t for _, t in plain if r["text"][: len(r["text"]) - third] + t[:third] == r["edited"]]
            assert options
            assert len(r["edited_signatures"]) == len(python_signatures(r["edited"]))
            a, b = set(r["signatures"]), set(r["edited_signatures"])
            x, y = sets[r["text"]], python_signatures(r["edited"])
            assert len(a & b) / len(a | b) == pytest.approx(len(x & y) / len(x | y))
            # the next document is one whose text the edited text borrows from; its set has the likeness of that text's
            near = len(a & set(r["next_signatures"])) / len(a | set(r["next_signatures"]))
            assert any(near == pytest.approx(len(x & sets[t]) / len(x | sets[t])) for t in options)
    assert spotsigs.compare_edited(none).count() == 0


def test_spotsigs_next(real, spark):
    rows = sorted(((r["doc_id"], r["text"]) for r in real.collect()), reverse=True)
    found = {r["doc_id"]: r["edited"] for r in spotsigs.compare_edited(real).collect()}
    for k, (i, t) in enumerate(rows):
        third, following = len(t) // 3, rows[(k + 1) % len(rows)][1]
        assert found[i] == t[: len(t) - third] + following[:third]
    one = spotsigs.compare_edited(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")).first()
    assert one["edited"] == "abcdab"
    nulls = spark.createDataFrame([(None, "xyzxyz"), (None, "uvwuvw"), (1, "abcabc")], "doc_id long, text string")
    made = {r["text"]: r["edited"] for r in spotsigs.compare_edited(nulls).collect()}
    assert len(made) == 3 and made["abcabc"][:4] == "abca" and sorted(e[4:] for e in made.values()) == ["ab", "uv", "xy"]


def test_spotsigs_keep_columns_of_any_name(spark):
    names = ["__clean", "__runs", "__anchored", "__found", "__range", "__head", "__target", "__place", "__at", "__copy", "__tie"]
    docs = spark.createDataFrame([(i, f"the word{i} of thing") for i in range(9)], "doc_id long, text string")
    for n in names:
        docs = docs.withColumn(n, F.lit(n))
    plain = spotsigs.with_next(spotsigs.with_signatures(docs.select("doc_id", "text"), "text", "s"), "doc_id", ["text", "s"])
    kept = spotsigs.with_next(spotsigs.with_signatures(docs, "text", "s"), "doc_id", ["text", "s"])
    assert kept.columns == ["doc_id", "text", *names, "s", "next_text", "next_s"] and all(r[n] == n for r in kept.collect() for n in names)
    assert sorted(map(tuple, kept.select(plain.columns).collect())) == sorted(map(tuple, plain.collect()))


def test_spotsigs_near_duplicates(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(300)]
    texts = []
    for _ in range(12):
        base = [rng.choice(["the", "of", "and"]) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(160)]
        for changes in (0, 1, 3, 30):
            own = list(base)
            for _ in range(changes):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    members, links = spotsigs.near_duplicates(docs)
    digest = {r["doc_id"]: r["digest"] for r in members.collect()}
    sets = {digest[i]: python_signatures(t) for i, t in enumerate(texts)}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    assert {(r["a"], r["b"]) for r in links.collect()} == want and len(want) > 10


def brute_matches(text, item, edits=decontaminate.EDITS):
    """The least edit distance of any passage to the item, by the textbook table."""
    a, b = decontaminate.words(item), decontaminate.words(text)
    row = [0] * (len(b) + 1)
    for i, w in enumerate(a, 1):
        new = [i]
        for j, v in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (w != v)))
        row = new
    return min(row)


def edited(rng, words, vocabulary, n):
    out = list(words)
    for _ in range(n):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice(vocabulary)
        elif kind == 1:
            out.insert(at, rng.choice(vocabulary))
        elif len(out) > 1:
            del out[at]
    return out


def test_decontamination_against_brute_force(spark, sf_dir):
    rng = random.Random(7)
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    vocabulary = [w for _, t in items for w in decontaminate.words(t)] + ["zz", "yy"]
    docs, k = [], 0
    for i, t in items:
        words = decontaminate.words(t)
        for share in (0, 0.1, 0.2, 0.35):
            passage = edited(rng, words, vocabulary, int(share * len(words)))
            docs.append((k, " ".join([*rng.choices(vocabulary, k=rng.randrange(40)), *passage, *rng.choices(vocabulary, k=rng.randrange(40))])))
            k += 1
    docs += [(1000, None), (1001, ""), (None, items[0][1].upper().replace(" ", "\n ")), (None, items[0][1]), (1002, "x " * 20_000 + items[1][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x")).withColumn("distance", F.lit(1))
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontaminate.matches(df, bench).collect()}
    want = {}
    for d, t in docs:
        if t and len(t) < 20_000:
            for i, item in items:
                n = len(decontaminate.words(item))
                found = brute_matches(t, item)
                if found <= decontaminate.allowed(n):
                    want[d, i] = found
    assert got.pop((1002, items[1][0])) == 0
    missed = {p for p in want if p not in got}
    assert len(missed) <= 0.01 * len(want) and not set(got) - set(want)
    assert all(got[p] == want[p] for p in got)


def test_decontamination_edges(spark, none):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "too short"), (4, "one two three four five"), (4, "one two three four five"), (None, "six seven eight nine ten")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a One, two; three four FIVE b"), (2, "six seven eight nine"), (3, "one two three"), (3, None)], "doc_id long, text string").withColumn("lang", F.lit("en"))
    got = sorted((r["doc_id"], r["item_id"], r["distance"], r["first_word"], r["end_word"]) for r in decontaminate.matches(docs.filter("doc_id = 1"), bench).collect())
    assert got == [(1, 4, 0, 1, 6)] * 2
    blocks = decontaminate.matches(docs, bench, block_chars=1).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in blocks), key=str) == [(1, 4), (1, 4), (2, None)]
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns and sorted(r["doc_id"] for r in clean.collect()) == [3, 3]
    assert decontaminate.matches(none, bench).count() == 0 and decontaminate.clean(docs, bench.limit(0)).count() == 4


@pytest.mark.parametrize("n", [60, 70, 400, 1200, 2000])
def test_repetitions_reach_the_recall(n):
    """On other pairs than those that the repetitions were found by; none is capped."""
    k = decontaminate.allowed(n)
    rng, times = np.random.default_rng(n + 1), decontaminate.repetitions(n, k)
    rows = [np.arange(1, n + 1)]
    for _ in range(1000 if n < 1000 else 400):
        own = rows[0].tolist()
        for new in range(k):
            at = int(rng.integers(len(own)))
            match int(rng.integers(3)):
                case 0:
                    own[at] = n + 1 + new
                case 1:
                    own.insert(at, n + 1 + new)
                case _:
                    del own[at]
        rows.append(np.array((own + [0] * n)[:n]))
    made = decontaminate.cgk_samples(np.stack(rows), times)
    assert (made[:, 1:] == made[:, :1]).any(0).mean() >= 0.997


def test_repetitions_of_many_lengths():
    import time

    for f in (decontaminate.repetitions, decontaminate._counted, decontaminate._estimated):
        f.cache_clear()
    began = time.process_time()
    found = [decontaminate.repetitions(n, decontaminate.allowed(n)) for n in range(20, 2020, 4)]
    assert len(found) == 500 and time.process_time() - began < 30 and max(found) > 256
    with pytest.raises(ValueError, match="takes over"):
        decontaminate.repetitions(400, 4000)


def test_best_passage():
    rng = np.random.default_rng(2)
    for _ in range(200):
        item, text = rng.integers(1, 5, rng.integers(1, 9)), rng.integers(0, 5, rng.integers(0, 20))
        distance, start, end = decontaminate.best_passage(item, text)
        assert distance == brute_matches(" ".join(map(str, text)), " ".join(map(str, item)))
        a, b = list(map(str, item)), list(map(str, text[start:end]))
        assert distance == _distance(a, b)


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, w in enumerate(a, 1):
        new = [i]
        for j, v in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (w != v)))
        row = new
    return row[-1]


PAGE = "page_id long, url string, html string"


def odd_pages(spark):
    big, twin = "<p>é日</p>" * 4000, "x" * 120
    return spark.createDataFrame([(1, "http://a/ b", big), (2, None, twin), (3, "http://c\r\nX: y", twin), (4, "http://d", None), (5, "http://e", ""), (6, "http://f", "short"), (7, "http://g", "short"), (8, "http://h", "a\r\n\r\nWARC/1.1\r\n\r\n" * 10), (9, "http://i", twin), (2, "http://z", twin), (None, "http://n", twin), (None, "http://o", "y" * 100), (10, "http://p", "y" * 100), (11, "http://q", "y" * 99), (12, "http://r", "y" * 99)], PAGE).withColumn("kind", F.lit("k")).withColumn("digest", F.lit("k"))


def test_warc_round_trip(spark):
    pages = odd_pages(spark)
    found = warc.captures(spark, warc.write(pages)).collect()
    assert sorted(((r["page_id"], bytes(r["payload"]) if r["payload"] is not None else None) for r in found if r["kind"] == "response"), key=str) == sorted(((r["page_id"], (r["html"] or "").encode()) for r in pages.collect() if r["page_id"] not in (3, 9) and not (r["page_id"] is None and r["html"][0] == "x") and not (r["page_id"] is None)), key=str)
    by = defaultdict(list)
    for r in found:
        by[r["page_id"]].append(r)
        assert len(r["requests"]) == len(r["metadata"]) == 1 and r["requests"][0]["http_head"].startswith("GET ")
    assert len(found) == pages.count() and {r["kind"] for r in by[2]} == {"response"} and by[3][0]["refers_to"] == by[9][0]["refers_to"] == 2
    assert sorted((r["kind"], r["refers_to"]) for r in by[None]) == [("revisit", 2), ("revisit", 10)]
    for r in pages.collect():
        body = (r["html"] or "").encode()
        assert any(x["payload_bytes"] == len(body) and x["payload_digest"] == hashlib.sha256(body).hexdigest() for x in by[r["page_id"]])


def test_warc_files_and_damage(spark, tmp_path):
    paths = warc.write(odd_pages(spark), f"file://{tmp_path}/w")
    assert paths and warc.write(odd_pages(spark).limit(0), f"file://{tmp_path}/none") == [] and warc.captures(spark, []).count() == 0
    path = paths[0].removeprefix("file://")
    raw = gzip.open(path).read()
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    with gzip.open(path, "wb") as f:
        f.write(raw.replace(b"GET ", b"PUT ", 1))
    with pytest.raises(Exception, match="block digest"):
        warc.read(spark, paths).collect()
    with gzip.open(path, "wb") as f:
        f.write(raw[:-20])
    with pytest.raises(Exception, match="ends early"):
        warc.read(spark, paths).collect()


def test_warc_assembly_of_incomplete_transactions(spark):
    rows = [("r1", "response", [], "d1"), ("q1", "request", ["r1"], None), ("m1", "metadata", ["r1", "r4"], None), ("m2", "metadata", ["r1"], None), ("r2", "response", None, "d2"), ("q3", "request", ["gone"], None), ("v1", "revisit", None, "d9"), ("q4", "request", None, None), ("r4", "response", ["q4", "m1", "nowhere"], "d4")]
    records = spark.createDataFrame(rows, "record_id string, kind string, concurrent_to array<string>, payload_sha256 string")
    for name in ("target_uri", "date", "content_type", "refers_to_uri", "stated_digest", "http_head", "fields"):
        records = records.withColumn(name, F.lit(None).cast("string"))
    records = records.withColumn("payload", F.lit(None).cast("binary")).withColumn("payload_bytes", F.lit(1).cast("long"))
    found = {r["record_id"]: (len(r["requests"]), len(r["metadata"]), r["refers_to"]) for r in warc.assemble(records).collect()}
    # r4 names its request, m1 and r4 name each other, and m1 names two captures
    assert found == {"r1": (1, 2, None), "r2": (0, 0, None), "v1": (0, 0, None), "r4": (1, 1, None)}


def test_warc_fields_as_the_format_has_them(spark, tmp_path):
    """Repeated and folded fields, and records without a Content-Type."""
    record = lambda kind, name, block, *more: ("\r\n".join(["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", *more, f"Content-Length: {len(block)}", "", ""])).encode() + block + b"\r\n\r\n"
    http = b"HTTP/1.1 200 OK\r\n\r\nbody"
    raw = record("response", "a", http, "Content-Type: application/http;", " msgtype=response", "WARC-Concurrent-To: <q>", "WARC-Concurrent-To: <m>") + record("request", "q", b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http") + record("metadata", "m", b"x: y") + record("resource", "z", b"")
    path = tmp_path / "x.warc.gz"
    path.write_bytes(gzip.compress(raw))
    rows = {r["record_id"]: r for r in warc.read(spark, [f"file://{path}"]).collect()}
    assert rows["<a>"]["concurrent_to"] == ["<q>", "<m>"] and rows["<m>"]["content_type"] is None and bytes(rows["<a>"]["payload"]) == b"body"
    (found,) = warc.captures(spark, [f"file://{path}"]).collect()
    assert [r["record_id"] for r in found["requests"]] == ["<q>"] and [r["record_id"] for r in found["metadata"]] == ["<m>"] and found["page_id"] is None


@pytest.mark.parametrize("name", sorted(queries_records.ORACLES))
def test_sql(spark, sf_dir, name, tmp_path):
    con = duckdb.connect()
    for t in ("pages", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    queries_records.QUERIES[name](spark, sf_dir).write.parquet(str(tmp_path / "o"))
    con.sql(f"CREATE TABLE wanted AS {queries_records.ORACLES[name]}")
    ours = f"(SELECT * FROM '{tmp_path}/o/*.parquet')"
    cols = ", ".join(r[0] for r in con.sql("DESCRIBE wanted").fetchall())
    for a, b in (("wanted", ours), (ours, "wanted")):
        assert con.sql(f"SELECT count(*) FROM (SELECT {cols} FROM {a} EXCEPT ALL SELECT {cols} FROM {b})").fetchall() == [(0,)]


def test_chat_cases(spark):
    turns = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "bot", "yes"), (3, 0, "user", "hi"), (3, 1, "bot", "yes"), (4, 5, "user", "hi"), (4, 9, "bot", "yes"), (4, 10, "user", "more"), (5, 0, "user", "hi"), (5, 1, "bot", "no"), (6, 0, None, None), (7, 0, None, ""), (8, 0, "user", "a<|im_end|>"), (8, 0, "user", "a<|im_end|>"), (9, 0, "user", "x"), (9, 0, "bot", "y"), (None, 0, "user", "lost"), (10, None, "user", "z"), (10, 0, "user", "w")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("n", F.lit("x")).withColumn("a", F.lit(1)).withColumn("t", F.lit(2))
    found = {r["conv_id"]: r for r in chat.collapse(df).collect()}
    assert set(found) == {4, 5, 6, 7, 8, 9, None, 10}
    assert found[4]["n_turns"] == 3 and found[8]["n_turns"] == 1 and found[6]["text"] == "<|im_start|>unknown\n<|im_end|>\n"
    assert found[8]["text"] == "<|im_start|>user\na< |im_end|><|im_end|>\n" and found[9]["text"].startswith("<|im_start|>bot") and found[10]["text"].startswith("<|im_start|>user\nz")
    same = spark.createDataFrame([(i, 0, "u", "t") for i in (5, 3, 9)], "conv_id long, turn long, role string, text string")
    assert [(r["conv_id"], r["n_copies"]) for r in chat.collapse(same).collect()] == [(3, 3)]
    assert chat.collapse(same.limit(0)).count() == 0


def test_chat_against_brute_force(spark):
    rng = random.Random(9)
    talks = [[(rng.choice("ab"), rng.choice("xyz")) for _ in range(rng.randrange(1, 6))] for _ in range(120)]
    rows = [(i, t, role, text) for i, talk in enumerate(talks) for t, (role, text) in enumerate(talk)]
    got = {r["conv_id"]: r["n_copies"] for r in chat.maximal(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    want = {}
    for i, talk in enumerate(talks):
        if not any(len(o) > len(talk) and o[: len(talk)] == talk for o in talks) and talks.index(talk) == i:
            want[i] = talks.count(talk)
    assert got == want


def test_chat_long_conversations(spark):
    """A conversation of many turns, one of it that ends early, one that differs in its last turn, and a turn with a very long text."""
    turns = [("user" if t % 2 == 0 else "bot", f"turn {t} " + "word " * 20) for t in range(400)]
    talks = {1: turns, 2: turns[:399], 3: [*turns[:399], ("bot", "other")], 4: [("user", "long " * 200_000)], 5: [("user", "long " * 200_000), ("bot", "yes")]}
    rows = [(i, t, role, text) for i, talk in talks.items() for t, (role, text) in enumerate(talk)]
    found = {r["conv_id"]: r for r in chat.collapse(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert set(found) == {1, 3, 5} and found[1]["n_turns"] == 400 and found[5]["n_turns"] == 2
    assert found[1]["text"].count("<|im_start|>") == 400 and len(found[5]["text"]) > 1_000_000


def test_warc_null_url_beside_a_long_payload(spark):
    long = "<p>é</p>" * 200_000
    pages = spark.createDataFrame([(1, None, long), (2, None, long), (3, "", long + "x"), (4, None, None), (None, None, None)], "page_id long, url string, html string")
    found = sorted(((r["page_id"], r["kind"], r["refers_to"], r["payload_bytes"]) for r in warc.captures(spark, warc.write(pages)).collect()), key=str)
    size = len(long.encode())
    assert found == sorted([(1, "response", None, size), (2, "revisit", 1, size), (3, "response", None, size + 1), (4, "response", None, 0), (None, "response", None, 0)], key=str)


def test_pipeline_against_brute_force(spark, sf_dir, real):
    """Each stage's decision made again in Python."""
    out = corpus_pipeline.run(spark, sf_dir)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "byte_bpe"] and corpus_pipeline.ORACLE_SQL is None
    rows = {r["doc_id"]: r for r in real.collect()}
    scorer = langid.Scorer(langid.train(real))
    kept = {}
    for i, r in rows.items():
        lang, score = scorer.predict(r["text"])
        if lang != "und" and score >= corpus_pipeline.MIN_SCORE:
            kept[i] = r["text"]
    # near copies of five-word shingles at a similarity of 0.8, as stages on word shingles take them
    kept = {i: kept[i] for i in brute_kept(list(kept.items()))}
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    sets = [(t, set(decontaminate.words(t))) for t in items]
    left = {}
    for i, t in kept.items():
        words = set(decontaminate.words(t))
        # a passage within the distance shares most of the item's words
        if not any(len(w & words) >= 0.6 * len(w) and brute_matches(t, item) <= decontaminate.allowed(len(decontaminate.words(item))) for item, w in sets):
            left[i] = t
    found = {r["doc_id"]: r for r in out.collect()}
    assert set(found) == set(left) and out.columns[: len(real.columns)] == real.columns
    encoder = bpe.encoder(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.tiktoken"), corpus_pipeline.public_tokenizers.PATTERN)
    assert all(r["ids"] == encoder.encode(r["text"]) and r["round_trip"] for r in found.values())


def test_pipeline_stages_on_odd_rows(spark, sf_dir, odd, none):
    odd = odd.withColumn("score", F.lit(1)).withColumn("fp", F.lit("x")).withColumn("label", F.lit(None).cast("string"))
    for name in ("__language", "language", "__key", "kept_id", "decoded", "coded", "ids", "round_trip"):
        odd = odd.withColumn(name, F.lit("own"))
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            if name != "byte_bpe":
                assert out.columns == docs.columns
            else:
                assert set(out.columns) == {*docs.columns, "ids", "n_tokens", "round_trip"} and all(r["round_trip"] is True for r in out.collect())
                assert docs is none or {(r["decoded"], r["coded"]) for r in out.collect()} == {("own", "own")}
            assert out.count() <= docs.count()
    assert {r["doc_id"] for r in corpus_pipeline.language_id(spark, odd, sf_dir).collect()} == {1, 2, 3, 8, 9, None, 10, -3}
    assert {r["language"] for r in corpus_pipeline.language_id(spark, odd, sf_dir).collect()} == {"own"}
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_id(spark, unlabelled, sf_dir).count() == 10


def test_queries_on_real_rows(spark, sf_dir, real):
    for query in (queries_text.op2_spotsigs, queries_text.op3_simhash):
        found = query(spark, sf_dir)
        assert found.count() == real.count()
    equal = queries_text.op2_spotsigs(spark, sf_dir).join(real, "doc_id").groupBy("text").agg(F.countDistinct("fingerprint").alias("n")).filter("n > 1")
    assert equal.count() == 0


def test_clear(spark):
    from inkspar.llm.common import clear, written

    table = written(spark.range(3), "x")
    path = table.inputFiles()[0].removeprefix("file://")
    assert table.count() == 3
    clear(spark)
    import os

    assert not os.path.exists(path)


def test_near_copies_against_brute_force(spark, odd, none):
    """Pairs of 0.8 that 3 bits of 3-word fingerprints don't link, chains, a group of copies of one text, and copies too far apart."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows = []
    for _ in range(10):
        base = [word() for _ in range(160)]
        for edits in (0, 0, 1, 2, 3, 4, 5, 8):
            own = list(base)
            for at in rng.sample(range(160), edits):
                own[at] = word()
            rows.append((len(rows), " ".join(own)))
    base = [word() for _ in range(200)]
    for n in range(60):
        # most are at about 0.7 of the text itself and at 0.5 of each other; every sixth is close to the one before
        own = (rows[-1][1].split() if n % 6 == 5 else list(base))
        for at in rng.sample(range(200), 2 if n % 6 == 5 else 7):
            own[at] = word()
        rows.append((len(rows), " ".join(own)))
    sets = {i: brute_sets(t) for i, t in rows}
    pairs = [(a, b) for a in sets for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    assert any((simhash.fingerprint(rows[a][1]) ^ simhash.fingerprint(rows[b][1])).bit_count() > 3 for a, b in pairs)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs).collect()) == sorted(brute_kept(rows))
    # the exact search alone finds all pairs: every node is a root of its own
    made = docs.select(jaccard.named_column(F.col("text")).alias("s"), "doc_id").select("s.fp", "s.shingles", "doc_id")
    different = made.dropDuplicates(["fp"])
    of = {r["doc_id"]: r["fp"] for r in made.collect()}
    found = jaccard.verified(jaccard.exact_pairs(different.select("fp", F.col("fp").alias("root")), different.select("fp", "shingles")), different).collect()
    assert {(r["u"], r["v"]) for r in found} == {tuple(sorted((of[a], of[b]))) for a, b in pairs if of[a] != of[b]}
    # one key that all share: pivots link some, the exact search the rest
    members = different.select(F.lit(1).alias("key"), "fp", F.lit(len(sets)).alias("n"))
    linked = {r["node"]: r["root"] for r in jaccard.linked(members, different.select("fp", "shingles")).collect()}
    nodes = set(of.values())
    assert grouped(nodes, linked.items()) == grouped(nodes, [(of[a], of[b]) for a, b in pairs if of[a] != of[b]])
    assert simhash.keep_one(none).count() == 0 and simhash.keep_one(odd).columns == odd.columns
    assert {r["doc_id"] for r in simhash.keep_one(odd).collect()} == {1, 3, 4, 7, 8, None, 10, -3}


def exploded_broadcasts(plan):
    """The broadcasts in a plan's text that are built from rows which an explode multiplies."""
    found, above = [], None
    for line in plan.splitlines():
        depth = next((i for i, c in enumerate(line) if c.isalpha()), 0)
        if above is not None and depth <= above:
            above = None
        if above is None and "BroadcastExchange" in line:
            above = depth
        elif above is not None and "Generate explode" in line:
            found.append(line.strip())
    return found


@pytest.fixture
def plans(monkeypatch):
    """(name, physical plan) of each table that the near-copy operators write."""
    made, plain = [], simhash.written

    def noted(df, name):
        made.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return plain(df, name)

    for module in ("simhash", "jaccard", "components"):
        monkeypatch.setattr(f"inkspar.llm.{module}.written", noted)
    return made


def test_keep_one_broadcasts_no_exploded_rows(real, plans):
    """Spark takes an explode's rows for as many bytes as its input's, so such a side is broadcast however large it is."""
    assert simhash.keep_one(real).count()
    assert {n for n, p in plans if "Generate explode" in p} >= {"near-sets", "members"}
    assert {n for n, p in plans if exploded_broadcasts(p)} == set()


def test_simhash_broadcasts_no_exploded_rows(real, plans):
    """Neither the index nor, where segment values are crowded (here all), their keys and the finer index."""
    docs = real.limit(60).union(real.limit(3))
    found = []
    for heavy in (1024, 0):
        found.append(sorted(map(tuple, simhash.classes(docs, heavy=heavy)[1].collect())))
        assert "Generate explode" in [p for n, p in plans if n == "edges"][-1]
    assert found[0] == found[1] and len(found[0]) > 1
    assert [n for n, p in plans if exploded_broadcasts(p)] == []


def test_shingle_hashes():
    texts = ["a b c d e f", "", None, "a B c", "b c d e f", "f e d c b a " * 300, "x"]
    lists = jaccard.shingle_lists(texts)
    assert [len(x) for x in lists] == [2, 0, 0, 1, 1, 1796, 1] and lists[0][1] == lists[4][0]
    assert all(x.tolist() == jaccard.shingle_lists([t])[0].tolist() for x, t in zip(lists, texts, strict=True))
    rng = np.random.default_rng(3)
    agree = []
    for _ in range(60):
        both, one, two = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (800, 100, 100))
        agree.append((jaccard.band_keys(np.concatenate([both, one])) == jaccard.band_keys(np.concatenate([both, two]))).mean())
    assert 0.36 < np.mean(agree) < 0.46 and min(agree) > 0
