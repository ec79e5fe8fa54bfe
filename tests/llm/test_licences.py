"""Licence notices: base places by words, fuzzy matches by edit distances of all stretches of words."""

import random
import re

import pytest

from tidewell.llm.licences import NOTICES, PHRASES, Searcher, base_places, joined_words, licence_labels, licence_spans, notice
from tidewell.llm.queries import op13_licence_scan, table

LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_base(text):
    w, out = words_of(text), []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        out += [(k, label) for k in range(len(w)) if w[k : k + len(p)] == p]
    labels = ",".join(sorted({x for _, x in out}))
    return len(w), len(out), min(out)[0] if out else None, max(out)[0] if out else None, labels


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def least_edits(stretch, parts):
    """Fewest edits of the free parts; the others stand as they are."""
    if len(parts) == 1:
        return distance(stretch, parts[0])
    free, fixed, *rest = parts
    found = [m.start() for m in re.finditer(f"(?={re.escape(fixed)})", stretch)]
    return min((distance(stretch[:k], free) + least_edits(stretch[k + len(fixed) :], rest) for k in found), default=99)


def plain_matched(text, spec):
    _, pattern, edits = spec
    w, parts = words_of(text), re.split(r"[\[\]]", pattern)
    size = len(pattern)
    for i in range(len(w)):
        for j in range(i + 1, len(w) + 1):
            stretch = " ".join(w[i:j])
            if len(stretch) > size + edits:
                break
            if least_edits(stretch, parts) <= edits:
                return True
    return False


def spoilt(rng, text, edits):
    for _ in range(edits):
        k = rng.randrange(len(text))
        text = rng.choice([text[:k] + text[k + 1 :], text[:k] + rng.choice("abe lx") + text[k:], text[:k] + rng.choice("abe x") + text[k + 1 :]])
    return text


def test_fuzzy_labels_against_edit_distances():
    rng, s = random.Random(2), Searcher()
    names = [t.replace("[", "").replace("]", "") for _, t, _ in NOTICES]
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(names))
            parts += [rng.choice(["the", "it", "on", "licensed", "under", "", "a b"]), spoilt(rng, names[k], rng.randint(0, NOTICES[k][2] + 2))]
        text = " ".join([*parts, rng.choice(["", "end"])])
        got = {(m.notice.label, m.notice.plain) for m in s.matches(joined_words(text.encode()))}
        assert got == {(n[0], p) for n, p in zip(NOTICES, names, strict=True) if plain_matched(text, n)}, text


def test_pieces_cover_the_notice():
    for spec in NOTICES:
        n = notice(*spec)
        assert "".join(p for _, p in n.pieces) == n.plain and len(n.pieces) == n.edits + 1 and all(n.plain[a : a + len(p)] == p for a, p in n.pieces)


def test_every_place_has_its_match():
    s = Searcher()
    joined = joined_words(b"MIT License mit licence, MIT\nLICENSE; the Apache Licence. GNU Genral Public-License Apache License")
    got = [(m.notice.plain, m.edits, joined[m.start : m.end]) for m in s.matches(joined)]
    assert [g for g in got if g[0] == "mit license"] == [("mit license", 0, "mit license"), ("mit license", 1, "mit licence"), ("mit license", 0, "mit license")]
    assert [g for g in got if g[0] == "apache license"] == [("apache license", 1, "apache licence"), ("apache license", 0, "apache license")]
    assert ("general public license", 1, "genral public license") in got


@pytest.mark.parametrize("text", ["the IT license", "bit licenses", "a public license", "general license", "permission granted", "licensed under oath", "apaches licence it", "smith license"])
def test_clean_texts_have_no_label(text):
    assert Searcher().matches(joined_words(text.encode())) == []


def test_labels(spark):
    texts = [None, "", " .,-", "MIT License", "mit license mit license, Apache-License", "xmit license", "the Apache Licence", "mit éa license MIT\n\nLicense", "word " * 5000 + "General Public License " + "mit license " * 3000, "all right reserved", "\x00mit\x7flicense"]
    docs = spark.createDataFrame([(t, "x", k) for k, t in enumerate(texts)] + [("MIT license", "x", None)] * 2, "text string, labels string, doc_id long").repartition(3)
    got = sorted(map(tuple, licence_labels(docs).drop("n_matches").collect()), key=repr)
    for id_, *base, labels, score in got:
        assert tuple(base) == plain_base("MIT license" if id_ is None else texts[id_])
        assert set(filter(None, base[-1].split(","))) <= set(labels.split(",")) and 0 <= score <= 1 and (score == 1) >= (base[1] > 0)
    by = {r[0]: r for r in got}
    assert by[6][5:] == ("", "apache", 1 - 1 / 14) and by[9][6] == "reserved" and by[5][6] == "" and by[0][1:] == (0, 0, None, None, "", "", 0.0)
    assert len([r for r in got if r[0] is None]) == 2


def test_spans_point_into_the_text(spark):
    text = "Ünder the\n\n«MIT-Licence», or (Apache License, Version 2.0)."
    docs = spark.createDataFrame([(1, text), (2, None), (3, "nothing")], "doc_id long, text string")
    got = sorted(map(tuple, licence_spans(docs).collect()), key=repr)
    assert all(text[r[6] : r[7]] == r[8] and r[0] == 1 and len(words_of(r[8])) == r[5] and words_of(text)[r[4]].strip("«»") == words_of(r[8])[0] for r in got)
    assert [(r[1], r[3], r[8]) for r in got if r[2] in ("mit license", "apache license")] == [("apache", 0, "Apache License"), ("mit", 1, "MIT-Licence")]


def test_base_of_whole_table(spark, sf_dir):
    want = sorted((r.doc_id, *plain_base(r.text)) for r in table(spark, sf_dir, "documents").collect())
    got = op13_licence_scan(spark, sf_dir)
    assert sorted(map(tuple, got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect())) == want
    assert got.where("n_base = 0 AND labels NOT IN ('', 'cc-by-nc', 'reserved')").count() == 0


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert licence_labels(empty).count() == licence_spans(empty).count() == 0


def test_base_places_may_overlap_in_order():
    assert base_places("general public license mit license") == [(0, "gpl"), (3, "mit")]
