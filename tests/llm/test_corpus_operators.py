"""Decontamination, near duplicates, sharding, classifiers and the pipeline: against brute force on small tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tidewell.llm import language_id, parity, quality
from tidewell.llm.components import components
from tidewell.llm.decontamination import Phrases, contamination, decontaminate, hits, merged
from tidewell.llm.jaccard_join import near_duplicates, one_of_each
from tidewell.llm.queries import op1_decontamination, op4_jaccard_join, op6_sharding, op7_quality_classifier, op8_language_id, table
from tidewell.llm.sharding import bounded_ring_shards, plan
from tidewell.llm.textwords import ALNUM, NOT_SPACE, shingle_sets, words

LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def brute_hits(texts, items, width=10):
    windows = defaultdict(set)
    for i, t in items:
        w = WORD.findall((t or "").translate(LOWER))
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows[tuple(w[k : k + width])].add(str(i))
    lengths, out = sorted({len(x) for x in windows}), []
    for t in texts:
        w, found = WORD.findall((t or "").translate(LOWER)), set()
        hit = [0] * len(w)
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    found |= windows[tuple(w[k : k + n])]
                    hit[k : k + n] = [1] * n
        out.append((len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), sum(hit) > 0))
    return out


def test_fm_index_against_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        letters = "abc"[: rng.randint(1, 3)] + "A.é"
        text = lambda n: " ".join(rng.choice(letters) for _ in range(n))  # noqa: E731,B023
        texts, items = [text(rng.randint(0, 60)) for _ in range(6)] + [None, ""], [(str(k), text(rng.randint(0, 16))) for k in range(5)]
        phrases = Phrases(sorted((i, t.encode()) for i, t in items))
        found = words([None if t is None else t.encode() for t in texts], ALNUM)
        got, want = hits(found, phrases), brute_hits(texts, items)
        for k, w in enumerate(want):
            own = got.document == k
            assert sum(b - a for a, b in merged(got.first[own], got.last[own])) == w[1]


def test_decontamination(spark, sf_dir):
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    got = {r.doc_id: tuple(r)[1:] for r in op1_decontamination(spark, sf_dir).collect()}
    rows = docs.collect()
    for r, want in zip(rows, brute_hits([r.text for r in rows], [(r.item_id, r.text) for r in bench.collect()]), strict=True):
        assert got[r.doc_id] == want
    passage = " ".join(f"w{k}" for k in range(30))
    odd = spark.createDataFrame([(1, f"before. {passage.upper()} after, it goes on", 0, "x"), (2, None, None, None), (3, "", 0, "x"), (4, "...", 3, None), (None, "short item", 10, "y"), (5, "clean text", 10, "z"), (5, "clean text", 10, "z")], "doc_id long, text string, n_chars long, items string")
    items = spark.createDataFrame([(10, passage, 1), (9, "Short item!", 2), (8, None, 3), (None, "clean text", 4), (7, "", 5), (10, passage, 6)], "item_id long, text string, spans int")
    c = {(r.doc_id, r.n_words): r for r in contamination(odd, items).collect()}
    assert len(c) == 6 and c[1, 35].n_hit == 30 and c[1, 35].items_sha256 == hashlib.sha256(b"10").hexdigest() and c[None, 2].n_items == 1 and not c[5, 2].contaminated
    left = sorted((r.doc_id or 0, r.text or "", r.n_chars, r["items"]) for r in decontaminate(odd, items).collect() if r.doc_id != 2)
    assert (1, "before.\nafter, it goes on", 25, "x") in left and [x[0] for x in left] == [1, 3, 4, 5, 5]
    assert contamination(odd, items.limit(0)).where("contaminated").count() == 0 and contamination(odd.limit(0), items).count() == 0


def test_many_benchmark_blocks(spark, sf_dir, monkeypatch):
    from tidewell.llm import decontamination as d

    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    one = sorted(map(tuple, contamination(docs, bench).collect()))
    real = d.benchmark_blocks
    monkeypatch.setattr(d, "benchmark_blocks", lambda *a, **k: real(*a, **(k | {"most": 2000})))
    assert len(list(d.benchmark_blocks(bench))) > 2
    assert sorted(map(tuple, contamination(docs, bench).collect())) == one


def test_passages_of_many_benchmark_blocks_are_cut_at_once(spark, sf_dir, monkeypatch):
    from tidewell.llm import decontamination as d

    a, b = [f"a{k}" for k in range(1, 13)], [f"b{k}" for k in range(1, 9)]
    items = [(1, " ".join(a)), (2, " ".join(a[4:] + b)), (3, " ".join(f"c{k}" for k in range(12)))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    # Overlapping items; a passage that a cut joins, of either item; words left without any; no hit; null.
    joined = lambda x, y: " ".join(x[:6] + y + x[6:]) + " end."
    texts = ["Start " + " ".join(a + b) + " end.", joined(items[0][1].split(), items[2][1].split()), joined(items[2][1].split(), items[0][1].split()), items[1][1], "No hit é.", None]
    docs = spark.createDataFrame([(k, x, k, len(x or "")) for k, x in enumerate(texts)], "doc_id long, text string, spans int, n_chars long")
    real, given = d.benchmark_blocks, table(spark, sf_dir, "documents")
    whole = table(spark, sf_dir, "benchmark")
    small, large = (sorted(decontaminate(*x).collect(), key=str) for x in ((docs, bench), (given, whole)))
    assert {r.text for r in small} == {"Start\nend.", "end.", "No hit é.", None}
    monkeypatch.setattr(d, "benchmark_blocks", lambda *x, **k: real(*x, **(k | {"most": 20})))
    owner = lambda words_: {k for k, p in enumerate(d.benchmark_blocks(bench)) for i in p.items if i in words_}
    assert len(owner({"1"}) | owner({"2"}) | owner({"3"})) > 1
    cut = decontaminate(docs, bench)
    assert sorted(cut.collect(), key=str) == small and contamination(cut, bench).where("contaminated").count() == 0
    monkeypatch.setattr(d, "benchmark_blocks", lambda *x, **k: real(*x, **(k | {"most": 12_000})))
    assert sorted(decontaminate(given, whole).collect(), key=str) == large


def brute_components(rows):
    """(doc_id, n, component) by comparing all pairs of sets that share a shingle."""
    sets = []
    for _, t in rows:
        w = SPACED.findall((t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted((-1 if i is None else i, len(sets[k]), (-1 if i is None else i) if not sets[k] else least.get(find(k), -1)) for k, (i, _) in enumerate(rows))


def answered(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in df.collect())


def test_near_duplicates(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    assert answered(op4_jaccard_join(spark, sf_dir)) == brute_components(rows)


def test_near_duplicates_at_the_threshold(spark):
    rng = random.Random(11)
    rows = []
    for family in range(12):
        n = rng.choice([1, 3, 6, 12, 30, 60, 200])
        base = [f"f{family}w{rng.randint(0, 400)}" for _ in range(n)]
        for _ in range(8):
            w = list(base)
            for _ in range(rng.randint(0, max(1, n // 25))):
                w[rng.randrange(len(w))] = f"x{rng.random()}"
            rows.append((len(rows), " ".join(w) + rng.choice(["", " ", "\n"])))
    rows += [(900, None), (901, ""), (902, " \n"), (None, rows[0][1]), (903, rows[5][1].upper()), (903, rows[5][1]), (904, "Aé b"), (905, "aé  B")]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, key string, sid int")
    assert answered(near_duplicates(df)) == brute_components(rows)
    kept = one_of_each(df)
    assert kept.columns == df.columns
    want = {c for _, n, c in brute_components(rows) if n} | {900, 901, 902}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("rounds", [0, 2])
def test_links_within_components(spark, monkeypatch, rounds):
    from tidewell.llm import jaccard_join as j

    for name, size in (("HOT_KEY", 5), ("BLOCK_SETS", 4), ("STAR_ROUNDS", rounds)):  # keys and components of more sets are dealt over tasks
        monkeypatch.setattr(j, name, size)
    rng, rows = random.Random(3), [(None, None), (1, ""), (2, "one two"), (3, "ONE  two")]
    for family in range(3):
        base = [f"f{family}w{k}" for k in range(90)]
        for _ in range(14):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = f"x{rng.random()}"
            rows += [(len(rows), " ".join(w))] * rng.choice([1, 1, 2])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = []
    for _, t in rows:
        w = SPACED.findall((t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    alike = lambda a, b: bool(a) and 4 * len(a & b) >= 3 * len(a | b)
    want = sorted((-1 if i is None else i, sum(alike(sets[k], s) for m, s in enumerate(sets) if m != k)) for k, (i, _) in enumerate(rows))
    got = near_duplicates(df)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_links) for r in got.collect()) == want and max(n for _, n in want) > 8
    assert answered(got) == answered(j.near_components(df)) == brute_components(rows)
    _, pairs = j.set_links(df)
    distinct = sorted(set(sets) - {frozenset()}, key=str)
    assert pairs.count() == pairs.distinct().count() == sum(alike(a, b) for k, a in enumerate(distinct) for b in distinct[:k])


def test_keys_find_every_link():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 50, 1 << parity.COUNT_BITS)
    for n in (1, 2, 3, 5, 8, 15, 31, 32, 47, 64, 200, 999):
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            gone, come = rng.integers(0, n // 4 + 1), rng.integers(0, n // 3 + 1)
            b = np.union1d(a[gone:], rng.integers(0, 1 << 63, come).astype(np.uint64))
            if len(b) and parity.linked(a, b):
                got, of = parity.keys([a, b], counts)
                assert len(np.intersect1d(got[of == 0], got[of == 1]))
                assert np.array_equal(got[of == 1], parity.keys([b], counts)[0]) and (of == 0).sum() <= 2 * (len(a) // 3 + 3)
                apart = np.bitwise_count((parity.bit_sketch(a) ^ parity.bit_sketch(b)).view(np.uint64)).sum()
                assert parity.distance(parity.wide_sketch(a), parity.wide_sketch(b)) <= len(np.setxor1d(a, b))
                assert apart <= len(np.setxor1d(a, b)) and 7 * apart <= len(a) + len(b)


def test_words_and_shingles():
    text = "A b  c\td\ne f " + "x" * 2000 + " é"
    found = words([text.encode(), None, b"", b"one two"], NOT_SPACE)
    assert np.diff(found.first).tolist() == [8, 0, 0, 2]
    assert [len(s) for s in shingle_sets(found, 5)] == [4, 0, 0, 1]
    again = words([b"ONE two", b"a b c d e f " + b"x" * 2000 + " é".encode()], NOT_SPACE)
    assert np.array_equal(shingle_sets(again, 5)[1], shingle_sets(found, 5)[0]) and np.array_equal(shingle_sets(again, 5)[0], shingle_sets(found, 5)[3])


def test_components(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(40)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)] + [(7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        lo, hi = sorted((find(a), find(b)))
        parent[hi] = lo
    assert got == {x: find(x) for x in parent}


def test_sharding(spark, sf_dir):
    docs = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    got = op6_sharding(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in got:
        raw = docs[r.doc_id].encode()
        assert r.size == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw) and r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 40
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    longest = max(len(t.encode()) for t in docs.values()) + 16
    assert max(sizes.values()) <= 1.001 * sum(sizes.values()) / 40 + 2 * longest
    odd = spark.createDataFrame([(None, None, 1), (1, "a", 2), (1, "a", 2), (2, None, 3)], "doc_id long, text string, seg int")
    assert bounded_ring_shards(odd).count() == 4 and bounded_ring_shards(odd.limit(0)).count() == 0


def test_ring_moves_little():
    rng = random.Random(1)
    loads = {k: rng.randint(1, 100) for k in range(4096)}

    def owners(shards):
        return {p["seg"]: p["shard"] for p in plan(loads, shards, 64, 0.25)}

    before, after = owners(20), owners(21)
    assert sum(before[k] != after[k] for k in loads) < 0.35 * len(loads)
    total = defaultdict(int)
    for p in plan(loads, 20, 64, 0.01):
        total[p["shard"]] += (loads[p["seg"]] if p["hi"] is None else p["hi"]) - p["lo"]
    assert sum(total.values()) == sum(loads.values()) and max(total.values()) <= 1.01 * sum(loads.values()) / 20 + 1


def test_language(spark):
    small = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.lang for r in table(spark, small, "documents").collect()}
    got = op8_language_id(spark, small).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(docs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([docs[r.doc_id] == r.lang_pred for r in held]) > 0.98 and all(0 <= r.score <= 1 for r in got)


def brute_code_length(trained, text, order):
    """Bits of text after the trained texts, by escapes from the longest context down, with plain dictionaries."""
    from math import log2

    seen = defaultdict(lambda: defaultdict(int))
    for raw in trained:
        padded = b" " * order + raw
        for at in range(order, len(padded)):
            for k in range(order + 1):
                seen[padded[at - k : at]][padded[at]] += 1
    bits, padded = 0.0, b" " * order + text
    for at in range(order, len(padded)):
        for k in range(order, -1, -1):
            after = seen.get(padded[at - k : at])
            if after is None:
                continue
            both = sum(after.values()) + len(after)
            if padded[at] in after:
                bits -= log2(after[padded[at]] / both)
                break
            bits -= log2(len(after) / both)
        else:
            bits += 8
    return bits


def test_language_code_lengths(spark):
    from pyspark.sql import functions as F

    rng = random.Random(3)
    make = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(1, 80)))
    rows = [(k, make("ab é") if k % 2 else make("bcd\n"), "xy"[k % 2]) for k in range(40)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.col("lang"))
    asked = [make("abcdé zQ").encode() for _ in range(30)] + [b"", None, b"\x00" * 9]
    for _ in range(2):  # new and remembered
        got = model.lengths(asked)
        for k, text in enumerate(asked):
            for j, name in enumerate(model.languages):
                want = brute_code_length([t.encode() for _, t, x in rows if x == name], text or b"", language_id.ORDER)
                assert got[k, j] == pytest.approx(want, abs=0.01)


def test_language_trees_are_bounded_and_keep_suffixes(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(language_id, "NODES", 1000)
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    model = language_id.fit(docs, F.col("lang"))
    for tree in model.trees:
        assert 0 < len(tree.nodes) <= 1000
        nodes = set(tree.nodes.tolist())
        for node in nodes:
            order = node >> language_id._ABOVE
            assert not order or node & language_id._BYTES[order - 1] | order - 1 << language_id._ABOVE in nodes


def test_language_of_odd_texts(spark):
    rows = [(1, "the cat and the dog", "en", 1), (2, "le chat et le chien", "fr", 1), (3, None, "en", 1), (4, "", None, 1), (5, "123 !!", None, 1), (1, "the cat and the dog", "en", 1), (None, "le chien", None, 1), (6, "the " * 50000, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    from pyspark.sql import functions as F

    model = language_id.fit(docs, F.col("lang"))
    got = {(r.doc_id, r.lang_pred) for r in language_id.identify(docs, model).collect()}
    assert got == {(1, "en"), (2, "fr"), (3, "und"), (4, "und"), (5, "und"), (None, "fr"), (6, "en")}
    assert sorted(r.doc_id or 0 for r in language_id.in_some_language(docs, model).collect()) == [0, 1, 1, 2, 6]
    none = language_id.fit(docs.limit(0), F.col("lang"))
    assert {r.lang_pred for r in language_id.identify(docs, none).collect()} == {"und"}


def test_quality(spark):
    small = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in table(spark, small, "labels").collect()}
    got = op7_quality_classifier(spark, small).collect()
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([p == q for p, q in held]) > 0.9 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_quality_of_odd_texts(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "x", 1), (3, "word " * 40000, 1), (3, "word " * 40000, 1)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(3, 1), (3, 1), (None, 1), (9, 0)], "doc_id long, quality int")
    assert quality.score(docs, quality.fit(docs, labels, F.lit(True))).count() == 5
    empty = quality.fit(docs.limit(0), labels.limit(0), F.lit(True))
    assert {r.score for r in quality.score(docs, empty).collect()} == {1.0}
    assert len(quality.features([None, b"", b"a", b"\n\n"])) == 4


def test_negative_risk_is_held_at_zero():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (3000, len(quality.NAMES)))
    x[:1500, 0] += 4
    model = quality.Model(x[:600], x, 0.5)
    assert model.score(x[:1500]).mean() > 0.7 > 0.3 > model.score(x[1500:]).mean()


@pytest.mark.parametrize("share", [0.2, 0.5, 0.85])
def test_class_prior_without_negatives(share):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (20000, len(quality.NAMES)))
    good = rng.random(20000) < share
    x[good, 0] += 5
    trusted, every = good & (rng.random(20000) < 0.4), np.ones(20000, bool)
    assert abs(quality.class_prior(x, trusted, every) - good.mean()) < 0.06
    assert quality.class_prior(x, ~every, every) == quality.class_prior(x[:0], every[:0], every[:0]) == 1.0


def test_pipeline(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "benchmark_passages", "token_ids"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialise(stage(spark, before, sf_dir), name)
        assert after.columns == docs.columns and 0.7 * before.count() <= after.count() <= before.count()
        before = after
    assert near_duplicates(before).where("component_id <> doc_id").count() <= 1  # cutting passages may bring two together
    assert contamination(before, table(spark, sf_dir, "benchmark")).where("contaminated").count() == 0
    final = corpus_pipeline.run(spark, sf_dir)
    assert final.count() == before.count() and final.where("NOT same_ids").count() == 0


def test_what_is_left_of_a_text_and_names_of_users_columns(spark, monkeypatch):
    from tidewell.llm import decontamination as d

    passage = " ".join(f"a{k}" for k in range(12))
    bench = spark.createDataFrame([(1, passage), (2, " ".join(f"b{k}" for k in range(12)))], "item_id long, text string")
    rows = [(1, passage + " 。", "s", "c", "k", 7), (2, passage + " .,", "s", "c", "k", 7), (3, "clean", "s", "c", "k", 7), (4, None, "s", "c", "k", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, TEXT string, __spans string, __cut string, __keep string, __nth int")
    want = [(1, "。"), (3, "clean"), (4, None)]
    for most in (d.benchmark_blocks.__defaults__ and None, 60):
        if most:
            real = d.benchmark_blocks
            monkeypatch.setattr(d, "benchmark_blocks", lambda *a, **k: real(*a, **(k | {"most": most})))  # noqa: B023
        got = decontaminate(docs, bench)
        assert got.columns == docs.columns
        assert sorted((r.doc_id, r.TEXT) for r in got.collect()) == want
    one = one_of_each(docs.unionByName(docs))
    assert one.columns == docs.columns and sorted(r.doc_id for r in one.collect()) == [1, 3, 4]
