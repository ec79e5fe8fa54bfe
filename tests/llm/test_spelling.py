"""Spelling variants against edit distances of all pairs, on small tables."""

import random
import re
import zlib
from collections import Counter

import pytest

from tidewell.llm.queries import op12_spelling_variants, table
from tidewell.llm.spelling import grams_of, last_of, near_pairs, taken, variants

LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(rows):
    n = Counter()
    for id_, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{word}".encode())
            n[word[: h % len(word)] + word[h % len(word) + 1 :] if h % 97 == 0 else word] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    by_gap = {}
    for w in n:
        for v in {w, *(w[:k] + "*" + w[k + 1 :] for k in range(len(w)))}:
            by_gap.setdefault(v, []).append(w)
    others = {w: {x for k in range(len(w)) for x in by_gap[w[:k] + "*" + w[k + 1 :]]} | {w[:k] + w[k + 1 :] for k in range(len(w)) if w[:k] + w[k + 1 :] in n} for w in n}
    for w in n:
        for x in list(others[w]):
            others[x].add(w)
    out, form = {}, {}
    for w in n:
        others[w].discard(w)
        best = min(others[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, form[w], root, n[w], len(others[w]), n[form[w]] if form[w] else None)
    return sorted(out.values())


def listed(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_near_is_edit_distance_of_one():
    assert near("abcde", "abcdx") and near("abcde", "abde") and near("abcde", "abcdee")
    assert not near("abcde", "abced") and not near("abcde", "abcde") and not near("abcde", "abc")


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(1)
    for _ in range(500):
        word = "".join(rng.choice("aabcé") for _ in range(rng.randint(4, 12)))
        counts = {word[k : k + 2]: rng.randint(1, 9) for k in range(len(word) - 1)}
        pivots, prefix = grams_of(word, counts)
        cost = lambda k: counts[word[k : k + 2]]  # noqa: E731,B023
        first = sorted(range(len(word) - 1), key=lambda k: (cost(k), word[k : k + 2], k))[:3]
        assert set(pivots) <= set(first) <= set(prefix) and pivots[1] - pivots[0] >= 2
        assert sum(map(cost, pivots)) == min(cost(i) + cost(j) for i in first for j in first if j - i >= 2)


@pytest.mark.parametrize("letters", ["ab", "abc", "abcdefé"])
def test_all_near_pairs_are_found(spark, letters):
    rng = random.Random(len(letters))
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(4, 8))) for _ in range(400)})
    got = near_pairs(spark.createDataFrame([(w, k + 1) for k, w in enumerate(words)], "word string, n long"))
    n = {w: k + 1 for k, w in enumerate(words)}
    assert sorted(map(tuple, got.collect())) == sorted((a, n[a], b, n[b]) for a in words for b in words if near(a, b))


def test_forms_are_followed_to_the_last(spark):
    links = [(f"w{k:02}", f"w{k + 1:02}") for k in range(20)] + [("x", "w03"), ("y", "z")]
    got = dict(map(tuple, last_of(spark.createDataFrame(links, "word string, form string")).collect()))
    assert got == {**{f"w{k:02}": "w20" for k in range(20)}, "x": "w20", "y": "z"}


def test_variants(spark):
    rng = random.Random(4)
    pool = ["colour", "color", "colours", "Colour", "ÉCOLES", "école", "écoles", "naïve", "naive", "naives", "short", "tiny", "word"]
    rows = [(k, " ".join(rng.choices(pool, k=rng.randint(0, 60))) + rng.choice(["", "1colour_colour", "×÷ÿÀñ×÷ÿÀñ", "\n"])) for k in range(150)]
    rows += [(7, None), (None, "colour colour colour"), (None, "colour colour colour"), (8, ""), (9, "é" * 3000 + " colour"), (10, "a" * 5)]
    docs = spark.createDataFrame([(t, "x", i) for i, t in rows], "text string, word string, doc_id long").repartition(3)
    assert listed(variants(docs)) == plain(rows)


def test_a_deletion_for_one_hash_in_97():
    words = [f"abcde{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}" for k in range(676)]
    got = Counter()
    taken(got, 3, " ".join(words))
    got += Counter()  # without zeros
    want = Counter()
    for w in words:
        h = zlib.crc32(f"3:{w}".encode())
        want[w[: h % 7] + w[h % 7 + 1 :] if h % 97 == 0 else w] += 1
    assert got == want and any(len(w) == 6 for w in got)


def test_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert listed(op12_spelling_variants(spark, sf_dir)) == plain(rows)


def test_empty_table(spark):
    assert variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
