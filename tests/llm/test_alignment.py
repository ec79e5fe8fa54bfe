"""Alignment of two tokenizers: fragments, ranges and the whole operator against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm import alignment
from tidewell.llm.alignment import Fragment, aligner, aligned, compose, composed, fragment_of, groups_of, in_range, ranges
from tidewell.llm.queries import op11_alignment, table, tokenizer_path
from tidewell.llm.token_counts import byte_letters

ODD = [
    None,
    "",
    " ",
    "   ",
    "\n",
    "\nword",
    "a",
    "  two  blanks ",
    "a \n b\n\n c \n",
    "tab\tand\r\nreturn \t x",
    "no break space  em　",
    "é▁x marker",
    "plain text, then ▁",
    "<|endoftext|> </s> <s> <0x0A> <unk>",
    "a\x00b\x1cc",
    "数学和计算机 日本語テキスト",
    "🙂🙂 👩‍👩‍👧 emoji",
    "it's we'll I'M 1234567 12.5%",
    "x" * 300,
    "the the the the",
]


@pytest.fixture(scope="module")
def paths():
    return tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def plain(rows, paths):
    """Whole texts through both libraries, then everything by dictionaries."""
    a, b, letters = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1]), byte_letters()
    a.encode_special_tokens = True
    per, count = [], Counter()
    for id_, text in rows:
        ids_a, ids_b, ends = [], [], []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            raw_a = [bytes(letters[c] for c in a.id_to_token(k)) for k in ids_a]
            raw_b = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in ids_b]
            whole = (" " + text).encode()
            if b"".join(raw_a) != whole or b"".join(raw_b) != whole:
                ids_a, ids_b = [], []
            else:
                for raw in (raw_a, raw_b):
                    at, own = 0, []
                    for x in raw:
                        at += len(x)
                        own.append(at)
                    ends.append(own)
        links, groups, i, j = [], [], 0, 0
        if ids_a:
            at_a, at_b = ({e: k for k, e in enumerate(x)} for x in ends)
            for e in sorted(at_a.keys() & at_b.keys()):
                k, m = at_a[e], at_b[e]
                links.append((ids_a[k], ids_b[m]))
                groups.append(",".join(map(str, ids_a[i : k + 1])) + "|" + ",".join(map(str, ids_b[j : m + 1])))
                i, j = k + 1, m + 1
        count.update(links)
        per.append((id_, len(ids_a), len(ids_b), ";".join(groups), links))
    best = defaultdict(int)
    for (x, y), n in count.items():
        best[y] = max(best[y], n)
    out = []
    for id_, n_a, n_b, groups, links in per:
        sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append((id_, n_a, n_b, len(links), len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), sha))
    return out


def listed(df):
    return sorted(map(tuple, df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=repr)


def test_compose_is_associative_and_splits_anywhere():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 30)
        ends = [sorted({*rng.sample(range(1, n + 1), rng.randint(1, n)), n}) for _ in range(2)]
        ids = [[rng.randint(0, 99) for _ in e] for e in ends]
        whole = groups_of(fragment_of(ids[0], ends[0], ids[1], ends[1])[0])
        bounds = [0, *sorted(rng.choices(range(n + 1), k=rng.randint(0, 4))), n]
        parts = []
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            own = [[(k, e) for k, e in zip(i, x, strict=True) if lo < e <= hi] for i, x in zip(ids, ends, strict=True)]
            parts.append(fragment_of([k for k, _ in own[0]], [e for _, e in own[0]], [k for k, _ in own[1]], [e for _, e in own[1]])[0])
        assert groups_of(composed(parts)) == whole
        while len(parts) > 1:  # any way to bracket
            k = rng.randrange(len(parts) - 1)
            parts[k : k + 2] = [compose(parts[k], parts[k + 1])]
        assert groups_of(parts[0]) == whole
        assert compose(Fragment(), parts[0]) == parts[0] == compose(parts[0], Fragment())


def test_ranges_give_the_tokens_of_the_whole(paths):
    rng = random.Random(8)
    al = aligner(*paths)
    words = ["the", "of", "naïve", "été", "x1,y", "don't", "a\nb", "数学和", "🙂", "q" * 40, "end.\n\nNew", " ", "\t", "nation"]
    for _ in range(40):
        text = " " + " ".join(rng.choice(words) for _ in range(rng.randint(1, 120)))
        raw = text.encode()
        cut = ranges(raw, rng.choice([7, 30, 100]), rng.choice([5, 20, 60]))
        assert [cut[0][1], cut[-1][2]] == [0, len(raw)] and all(x[2] == y[1] for x, y in zip(cut, cut[1:], strict=False))
        whole = in_range(al, text, 0, len(raw))
        found = [in_range(al, raw[left:right].decode(), lo - left, hi - left) for left, lo, hi, right in cut]
        assert groups_of(composed(f[0] for f in found)) == groups_of(whole[0])
        assert Counter(p for f in found for p in f[1].tolist()) == Counter(whole[1].tolist())
        assert [sum(f[k] for f in found) for k in (2, 3)] == list(whole[2:4])


@pytest.mark.parametrize(("longest", "block"), [(1 << 16, 1 << 20), (200, 300), (40, 1)])
def test_aligned_against_whole_texts(spark, sf_dir, paths, longest, block):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(3, "again"), (3, "again"), (None, "null id"), (None, "null id")]
    rows += [(1000 + r.doc_id, r.text) for r in table(spark, sf_dir, "documents").where("doc_id % 9 = 1").select("doc_id", "text").collect()]
    docs = spark.createDataFrame([(t, "clash", i) for i, t in rows], "text string, block string, doc_id long").repartition(3)
    assert listed(aligned(docs, *paths, longest=longest, block=block)) == sorted(plain(rows, paths), key=repr)


def test_whole_table_and_long_text(spark, sf_dir, paths):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    joined = docs.agg(F.lit(-1).cast("long").alias("doc_id"), F.array_join(F.array_sort(F.collect_list("text")), " ").alias("text"))
    rows = [tuple(r) for r in docs.unionByName(joined).collect()]
    assert listed(aligned(docs.unionByName(joined), *paths)) == sorted(plain(rows, paths), key=repr)
    assert listed(op11_alignment(spark, sf_dir)) == sorted(plain(rows[:-1], paths), key=repr)


def test_empty_table(spark, paths):
    assert aligned(spark.createDataFrame([], "doc_id long, text string"), *paths).count() == 0


def test_memory_of_cuts_is_bounded(paths):
    al, fresh = alignment.Aligner(*paths), alignment.Aligner(*paths)
    al.MOST = 10
    for k in range(30):
        met = {f" w{k}", f" v{k % 4}", " it's", "\nx", " ▁"}
        al.learn(met)
        fresh.learn(met)
        assert len(al.known.number) <= 10 and met <= al.known.number.keys()
        for c in met:
            i, j = al.known.number[c], fresh.known.number[c]
            assert al.known.groups[i] == fresh.known.groups[j] and al.known.exact[i] == fresh.known.exact[j] == (c != " ▁")
            assert al.known.pairs_of(np.array([i]))[0].tolist() == fresh.known.pairs_of(np.array([j]))[0].tolist()


def test_cuts_learnt_together_are_as_alone(paths):
    rng = random.Random(6)
    al = aligner(*paths)
    words = {" " + "".join(rng.choice("aeiouthn.,'\"-1é数🙂") for _ in range(rng.randint(1, 12))) for _ in range(3000)}
    al.learn(words)
    for c in words:
        t, k = al.tokens(c), al.known.number[c]
        fragment, links = fragment_of(*t[:4])
        assert groups_of(fragment) == al.known.groups[k] and [a << 32 | b for a, b in links] == al.known.pairs_of(np.array([k]))[0].tolist()
        assert (len(t.a), len(t.b), t.exact) == (al.known.n_a[k], al.known.n_b[k], al.known.exact[k])
