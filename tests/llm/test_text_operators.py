"""Token counts, SentencePiece, media, chunk store, HTML: exact against the libraries, and odd inputs."""

import hashlib
import random
import zlib
from array import array

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidewell.llm import chunk_store, media
from tidewell.llm.html_text import extracted, main_text
from tidewell.llm.queries import op2_token_counts, op3_sentencepiece, op5_media_columns, op9_chunk_store, op10_html_extraction, table, tokenizer_path
from tidewell.llm.sentencepiece_codec import Codec, ModelFile, backend, encoding_report
from tidewell.llm.token_counts import PrefixCounter, token_counts

BPE, PIECES = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ODD = ["", " ", "a", "don't we'll I'VE 'tis y'all're", "  two  spaces\n\n\n and\n \nb\t\tx \t y", "a<|endoftext|>b <|endoftext|> c<|endof", "日本語 テスト　全角", "!!!'s ???'re 12 345 x.", "\n", "x\r\ny\r\n\r\n z", "é àb. ²³, ½ 🙂🙂 👩‍👩‍👧", "a" * 300, "=" * 500, "\x1c \x1d a\x85b", "a.,. ,b .c ..", " .x. a,\nb.\n", "▁x ▁▁ y", "<s> </s> <0x41>", " " * 51 + "z"]
DOCS = "doc_id long, text string, id string, n long, key int"


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [(k, x, "clash", k, 0) for k, x in enumerate(ODD)] + [(None, None, None, None, None), (1, " ", "again", 1, 1), (1, " ", "again", 1, 1)]
    return spark.createDataFrame(rows, DOCS)


def texts_of(df):
    return [r.text or "" for r in df.collect()]


def test_token_counts(spark, odd_docs, sf_dir):
    library = Tokenizer.from_file(BPE)
    n = lambda x: len(library.encode(x or "", add_special_tokens=False).ids)
    got = token_counts(odd_docs, BPE, 20).collect()
    assert len(got) == odd_docs.count()
    assert sorted((r.doc_id or -1, r.n_tokens, r.over_limit) for r in got) == sorted((r.doc_id or -1, n(r.text), n(r.text) > 20) for r in odd_docs.collect())
    whole = {r.doc_id: r for r in op2_token_counts(spark, sf_dir).collect()}
    for r in table(spark, sf_dir, "documents").collect():
        assert (whole[r.doc_id].n_tokens, whole[r.doc_id].n_bytes) == (n(r.text), len(r.text.encode()))
    assert token_counts(odd_docs.limit(0), BPE).count() == 0


@pytest.mark.parametrize("text", ODD)
def test_count_at_every_prefix(text):
    counter, library = PrefixCounter(BPE), Tokenizer.from_file(BPE)
    counts = counter.prefix_counts(text)
    for k in range(len(text) + 1):
        assert counts[len(text[:k].encode())] == len(library.encode(text[:k], add_special_tokens=False).ids)
    fit = counter.fit(text, 3)
    assert counter.count(text.encode()[:fit].decode()) <= 3


@pytest.mark.parametrize("text", [*ODD, "one\ttwo three's\r\nfour\r\n\r\n  five\xa0six", "\t\t \n \n\n\t x \t\n\n\n\n y", "東京都は日本の首都である世界最大の都市", "aGVsbG8gd29ybGQhISBoZWxsbyB3b3JsZA==" * 2, "a=+<|endoftext|>b", "x <<|endoftext|>\ty"])
def test_fit_is_the_longest_prefix(text):
    counter, library = PrefixCounter(BPE), Tokenizer.from_file(BPE)
    counts = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
    for budget in range(counts[-1] + 2):
        want = max(k for k, n in enumerate(counts) if n <= budget)
        assert counter.fit(text, budget) == len(text[:want].encode())


def test_fit_of_texts_in_one_unit(spark):
    library = Tokenizer.from_file(BPE)
    rows = [(1, "word\tand more, " * 900), (2, "東京都は日本の首都" * 400), (3, "line\r\n" * 900)]
    for r in token_counts(spark.createDataFrame(rows, "doc_id long, text string"), BPE).collect():
        raw = rows[r.doc_id - 1][1].encode()
        n = lambda k: len(library.encode(raw[:k].decode(), add_special_tokens=False).ids)  # noqa: E731,B023
        after = [k for k in range(r.fit_bytes + 1, r.fit_bytes + 40) if raw[k] & 0xC0 != 0x80]
        assert r.over_limit and n(r.fit_bytes) <= 1024 < min(map(n, after))


def test_sentencepiece(spark, odd_docs, sf_dir):
    theirs = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ours = Codec(PIECES)
    rng, signs = random.Random(2), [*" \n  ab.▁é中\t\x01😀", " word", "</s>", "<unk>", "\ufffd"]
    odd = [*ODD, *("".join(rng.choices(signs, k=rng.randint(0, 12))) for _ in range(2000))]
    ids, same, restored = ours.encode(odd)
    assert [array("I", x).tolist() for x in ids] == theirs.encode(odd) and all(same)
    assert restored == [ours.decode(x) == text for x, text in zip(ids, odd, strict=True)] and not all(restored)
    ours.MOST = 300  # so that cuts are set aside and met again
    assert [ours.encode([x])[0][0] for x in odd] == ids
    ids = ids[: len(ODD)]
    assert [ours.decode(x) for x in ids] == theirs.decode(theirs.encode(ODD))
    report = encoding_report(odd_docs, PIECES).collect()
    assert len(report) == odd_docs.count() and all(r.same_ids for r in report)
    whole = {r.doc_id: r for r in op3_sentencepiece(spark, sf_dir).collect()}
    for r in table(spark, sf_dir, "documents").collect():
        want = np.array(theirs.encode(r.text), "<u4").tobytes()
        assert (whole[r.doc_id].ids_crc32, whole[r.doc_id].n_tokens) == (zlib.crc32(want), len(want) // 4) and whole[r.doc_id].restored


def test_unigram_backend():
    pieces = [("<unk>", 0.0, 2), ("▁a", -1.0, 1), ("b", -2.0, 1), ("▁ab", -2.5, 1)] + [(f"<0x{k:02X}>", -9.0, 6) for k in range(256)]
    out = backend(ModelFile(pieces=pieces, kind=1, byte_fallback=True))
    assert out.encode("ab").tokens == ["▁ab"] and out.encode(" aé ").tokens == ["▁a", "<0xC3>", "<0xA9>"]


def test_media(spark, odd_docs):
    rows = media.media_features(media.to_media(odd_docs)).collect()
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    assert len(rows) == odd_docs.count()
    for r in rows:
        payload = media.payload_of(texts[r.doc_id].encode())
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-64:]) and len(payload) % 64 == 0 and payload and r.error is None
    broken = spark.createDataFrame([(1, 0, bytearray(b"RIFF....")), (2, 0, None), (3, 0, bytearray(media.write_avi(b"x" * 64)[:-20]))], "doc_id long, n_bytes long, media binary")
    assert all(r.error and r.payload_bytes is None for r in media.media_features(broken).collect())


def test_media_of_any_bytes_and_shots(spark):
    rng = random.Random(3)
    for data in (b"", bytes(range(256)) * 9, rng.randbytes(5000), b"\xff" * 3000):
        assert media.read_avi(media.write_avi(data)).payload == data
    scenes = b"".join(bytes([v]) * 1024 * 5 for v in (10, 120, 240))
    df = spark.createDataFrame([(7, 0, bytearray(media.write_avi(scenes)))], "doc_id long, n_bytes long, media binary")
    got = media.clips(df).orderBy("clip").collect()
    assert [(r.first_frame, r.frames) for r in got] == [(0, 5), (5, 5), (10, 5)] and got[1].start_s == 0.2 and got[2].end_s == 0.6


def test_media_query_is_whole(spark, sf_dir):
    docs = {r.doc_id: r.text.encode() for r in table(spark, sf_dir, "documents").collect()}
    for r in op5_media_columns(spark, sf_dir).collect():
        assert r.payload_sha256 == hashlib.sha256(media.payload_of(docs[r.doc_id])).hexdigest() and r.n_bytes == len(docs[r.doc_id])


def test_chunk_store(spark, odd_docs, sf_dir):
    library = Tokenizer.from_file(BPE)
    ids = lambda x: [*library.encode(x or "", add_special_tokens=False).ids, 2]
    docs = sorted(table(spark, sf_dir, "documents").collect(), key=lambda r: r.doc_id)
    got = {r.doc_id: r for r in op9_chunk_store(spark, sf_dir).collect()}
    start = 0
    for r in docs:
        want = np.array(ids(r.text), "<u4")
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32, got[r.doc_id].intact) == (start, len(want), zlib.crc32(want.tobytes()), True)
        start += len(want)
    store = chunk_store.write(odd_docs.repartition(3), BPE)
    back = chunk_store.reconstructed(spark, store).collect()
    assert sorted((r.doc_id or -1, list(r.ids)) for r in back) == sorted((r.doc_id or -1, ids(r.text)) for r in odd_docs.collect())
    stored = spark.read.parquet(store.chunks).where("ids IS NOT NULL")
    assert stored.count() == stored.select("digest").distinct().count()
    assert chunk_store.verified(spark, chunk_store.write(odd_docs.limit(0), BPE)).count() == 0


def test_ids_by_units():
    ours, library = chunk_store.encoder(BPE), Tokenizer.from_file(BPE)
    rng, signs = random.Random(1), list(" \n\n  ab.,'s1é中\t!$\x01") + [" word", "<|endoftext|>"]
    for text in ["", "a\n\n\nb  ", "***. x", "\x01 a", "中文 字。ab", *("".join(rng.choices(signs, k=rng.randint(0, 14))) for _ in range(3000))]:
        assert np.frombuffer(ours.encode(text), ours.dtype).tolist() == library.encode(text, add_special_tokens=False).ids


def test_ids_of_many_texts():
    ours, library = chunk_store.Encoder(BPE), Tokenizer.from_file(BPE)
    rng, plain = random.Random(2), list(" ab.,1éßÿÀ!$#*") + [" w", " th", "ing", "\nT", "Ãé", "ations", " 9", ";("]
    texts = ["".join(rng.choices(plain, k=rng.randint(1, 20))) for _ in range(3000)]
    ids = lambda got: [np.frombuffer(x, ours.dtype).tolist() for x in got]
    want = lambda texts: [library.encode(x, add_special_tokens=False).ids for x in texts]
    spaced = [x for x in texts if chunk_store.single_spaced(x) and len(x.encode()) <= 40]
    assert len(spaced) > 500 and ids(ours.many(spaced)) == want(spaced)
    assert not ours.of_key  # no word was encoded by itself
    odd = [" \n\n  ab.,'s", "<|endoftext|>", "中", "don't", "\x01 a", "\t", "\x00", "÷×é", "x" * 99, "é" * 24, "é" * 25, "\nA", "a\n", ""]
    mixed = texts + odd + [rng.choice(texts) + rng.choice(odd) + rng.choice(texts) for _ in range(2000)]
    assert ids(ours.many(mixed)) == want(mixed) and ours.many([]) == []


def test_crc_of_parts():
    rng = np.random.default_rng(1)
    for after in (0, 1, 4, 1000, 70001):
        a, b = rng.bytes(50), rng.bytes(after)
        assert int(chunk_store.crc_shifted(np.array([zlib.crc32(a)]), np.array([after]))[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)


def test_chunk_store_finds_lost_chunks(spark):
    from pyspark.sql import functions as F

    words_ = [" ".join(f"w{k * k % (997 + d)}" for k in range(6000)) for d in range(3)]
    store = chunk_store.write(spark.createDataFrame(list(enumerate(words_, 1)), "doc_id long, text string"), BPE)
    whole = {r.doc_id: r for r in chunk_store.verified(spark, store).collect()}
    assert all(r.intact and r.n_chunks > 1 for r in whole.values())
    chunks = spark.read.parquet(store.chunks)
    # One chunk of document 1 and all of document 2 are gone; document 3's recipe is cut short.
    gone = chunks.where("id = 1").groupBy().agg(F.min("digest").alias("d")).first().d
    chunks.where((F.col("digest") != F.lit(gone)) & (F.col("id") != 2)).write.parquet(store.chunks + "-lost")
    recipes = spark.read.parquet(store.recipes)
    recipes.withColumn("parts", F.when(F.col("id") == 3, F.slice("parts", 1, F.size("parts") - 1)).otherwise(F.col("parts"))).write.parquet(store.recipes + "-short")
    got = {r.doc_id: r for r in chunk_store.verified(spark, chunk_store.Store(store.chunks + "-lost", store.recipes + "-short")).collect()}
    assert sorted(got) == [1, 2, 3] and not any(r.intact for r in got.values())
    assert 0 < got[1].n_tokens < whole[1].n_tokens and got[2].n_tokens == 0 and got[3].n_tokens < whole[3].n_tokens


def test_chunk_store_finds_damage(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, "three")], "doc_id long, text string")
    store = chunk_store.write(docs, BPE)
    damaged = spark.read.parquet(store.chunks).selectExpr("row", "id", "seq", "at", "total", "digest", "n", "CASE WHEN id = 1 THEN unhex('00000000') ELSE ids END AS ids", "root")
    damaged.write.parquet(store.chunks + "-damaged")
    got = {r.doc_id: r.intact for r in chunk_store.verified(spark, chunk_store.Store(store.chunks + "-damaged", store.recipes)).collect()}
    assert got == {1: False, 2: True}


def test_shared_passages_share_chunks():
    rng = np.random.default_rng(1)
    passage, a, b = rng.integers(0, 50000, 4000), rng.integers(0, 50000, 700), rng.integers(0, 50000, 900)
    streams = [np.concatenate([a, passage]), np.concatenate([b, passage])]
    chunks = []
    for s in streams:
        cuts = chunk_store.cut_points(s.astype("<u2"), np.array([0]), np.array([len(s)]))[0].tolist()
        chunks.append({s[x:y].tobytes() for x, y in zip([0, *cuts], cuts)})
        assert cuts[-1] == len(s) and max(np.diff([0, *cuts])) <= chunk_store.MOST
    assert len(chunks[0] & chunks[1]) >= 4


def test_html(spark, sf_dir):
    page = """<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Home</a></nav><div class="ad">Buy!</div>
    <article><h1>Head &amp; more</h1><p>First,   <b>bold</b> text.<p>Second&nbsp;one.<br>After the break.</p><script>var a="</p>";</script><form><p>Mail?</p></form><ul><li>Item one.</li></ul></article>
    <div class="comments"><p>I agree, very much. So do I.</p></div><footer>&copy; me</footer></body></html>"""
    assert main_text(page) == "Head & more\n\nFirst, bold text.\n\nSecond one. After the break.\n\nItem one."
    plain = "<div><a href=1>One</a> <a href=2>Two</a></div><div><p>Some text, long enough to read. It goes on.</p><p>More text, and more. Again.</p></div>"
    assert main_text(plain) == "Some text, long enough to read. It goes on.\n\nMore text, and more. Again."
    rows = [(1, "u", page, "x"), (2, None, None, None), (3, "u", "", None), (4, "u", "<p", None), (1, "u", page, "x"), (5, "u", "<p>" + "word, " * 20000, "y")]
    got = extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == 6 and sorted(r.n_chars for r in got)[:2] == [0, 0] and all(r.n_chars == len(r.text) for r in got)
    assert max(r.n_chars for r in got) == len("word, " * 20000) - 1
    whole = op10_html_extraction(spark, sf_dir).collect()
    assert len(whole) == table(spark, sf_dir, "pages").count() and all(r.n_chars > 0 for r in whole)


def test_html_names_only_weigh():
    story = "".join(f"<p>Sentence {k} of the story, which goes on for a while. It has commas, and stops.</p>" for k in range(6))
    want = [f"Sentence {k} of the story, which goes on for a while. It has commas, and stops." for k in range(6)]
    card = "<article class=card><a href=x>A teaser in a link</a> By me</article>"
    assert set(want) <= set(main_text(f"<body><div class=story>{story}</div>{card * 3}</body>").split("\n\n"))
    lead = "The lead tells in a sentence, or two, what the story is about."
    assert main_text(f"<main><h1>Headline of it</h1><p>{lead}</p><article>{story}</article></main>").split("\n\n") == ["Headline of it", lead, *want]
    for wrap in ("div class='page has-sidebar'", "div class=share", "form id=search", "div class=sidebar"):
        tag = wrap.split()[0]
        assert main_text(f"<body><nav>Here, there.</nav><{wrap}><article>{story}</article><div class=ad>Buy this, now.</div></{tag}></body>").split("\n\n") == want
    widgets = "".join(f"<div class=widget>{x}</div>" for x in want)
    assert main_text(f"<body>{widgets}<div class=comments><p>I agree, very much.</p></div></body>").split("\n\n") == want
    assert main_text(f"<body><article>{story}</article><div>Tags</div><footer>{'Copyright, all of it. ' * 99}</footer></body>").split("\n\n") == want


STORY = "<p>The council met on Monday, and voted for the new bridge.</p>"
LONG = "<p>I think that this is a rather long one, which goes on and on; and on, I fear.</p>" * 12
TOLD = "The council met on Monday, and voted for the new bridge."


@pytest.mark.parametrize("name", ["comments", "sidebar", "footer", "ad", "related"])
def test_long_parts_beside_a_short_article_stay_out(name):
    assert main_text(f"<body><div class=story>{STORY}</div><div class={name}>{LONG}</div></body>") == TOLD
    assert main_text(f"<body><div class={name}>{LONG}</div><article><h1>A bridge</h1>{STORY}</article></body>") == f"A bridge\n\n{TOLD}"


def test_an_article_under_a_barred_name_stays_where_nothing_else_is_one():
    menu = "<ul><li><a href=x>One</a><li><a href=y>Two</a></ul>"
    assert main_text(f"<body><div class=overlay>{STORY}{STORY}</div>{menu}</body>") == f"{TOLD}\n\n{TOLD}"


def test_pictures_and_their_captions():
    assert main_text(f"<body><svg/><div>{STORY}</div></body>") == main_text(f"<body><svg class=x><path d=y /></svg><div>{STORY}</div></body>") == TOLD
    assert main_text(f"<article>{STORY}<figure><img src=x><figcaption>The bridge, seen from the east.</figcaption></figure></article>") == f"{TOLD}\n\nThe bridge, seen from the east."
