"""Groups of spelling variants by pivotal grams.

Words are near if one inserted, deleted or replaced code point makes one the other. A word's bigrams are
ordered by how many words have them, the rarest first. Its prefix is its first three and all bigrams of
the third's rank; its pivots are two disjoint ones of the first three with the smallest frequencies in
sum, found by dynamic programming over places. One edit spoils at most one of two disjoint bigrams. So of
two near words, that whose third bigram isn't the rarer in rank has both pivots among bigrams no rarer than
the other's limit, and a pivot that's left stands in the other's prefix: pivots of all words meet prefixes
of all words. All before a pivot that's left is equal or all after it, as there's one edit: these parts
belong to the keys, and lengths differ by one at most, which holds places together as limits of positions
would. What meets is verified by edit distance in the join itself.

Counting words is done in bounded tables of each task, then by word. Forms are followed by pointer jumping.

Defined results: null texts have no words; a null id counts as empty text in the hash that picks deletions;
repeated rows count each; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import decoded, id_and_text, slices, texts
from tidewell.llm.textwords import LOWER
from tidewell.session import materialise, ready

SHORTEST, LEAST, SPOILED = 5, 3, 97
RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{SHORTEST},}}")
WHOLE = 2  # see _keys
HELD = 200_000  # words that a task holds


def taken(held: Counter, id_: int | None, text: str) -> None:
    """Counts the words of a lower-cased text; where 97 divides the hash of id and run, one code point is missing."""
    start = zlib.crc32(f"{'' if id_ is None else id_}:".encode())
    runs = RUN.findall(text)
    held.update(runs)
    crc = zlib.crc32
    for run in [r for r in set(runs) if not crc(r.encode(), start) % SPOILED]:
        n, k = runs.count(run), crc(run.encode(), start) % len(run)
        held[run] -= n
        if len(run) > SHORTEST:
            held[run[:k] + run[k + 1 :]] += n


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of words of at least five code points that stand three times or more."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def row() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in slices(batches):
            for id_, raw in zip(batch.column("id").to_pylist(), texts(batch), strict=True):
                taken(held, id_, decoded(raw and raw.translate(LOWER)))
                if len(held) >= HELD:
                    yield row()
        if held:
            yield row()

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def gram_counts(words: DataFrame) -> dict[str, int]:
    """How many words have each bigram. The words have 90 letters, so there are 8,100 bigrams at most, whatever the words' number."""
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda k: F.substring("word", k, F.lit(2))))
    return {r.gram: r.n for r in words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("n")).collect()}


def grams_of(word: str, counts: dict[str, int]) -> tuple[list[int], list[int]]:
    """(pivots, prefix) of a word, as places of bigrams."""
    rank = [(counts.get(word[k : k + 2], 0), word[k : k + 2]) for k in range(len(word) - 1)]
    first = sorted(range(len(rank)), key=lambda k: (rank[k], k))[:3]
    limit = rank[first[-1]]
    # Over places from the left: the cheapest first pivot that ends before this place, and the cheapest pair up to it.
    best, single = None, None
    waiting: list[int] = []
    for k in sorted(first):
        while waiting and waiting[0] <= k - 2:
            j = waiting.pop(0)
            if single is None or rank[j][0] < rank[single][0]:
                single = j
        if single is not None and (best is None or rank[single][0] + rank[k][0] < best[0]):
            best = (rank[single][0] + rank[k][0], single, k)
        waiting.append(k)
    return [best[1], best[2]], [k for k in range(len(rank)) if rank[k] <= limit]


def _keys(word: str, places: list[int]) -> list[str]:
    """What two near words share beside a bigram at a place, if it's left: all up to its end, or all from its beginning, and of
    the other side all but one half, which holds the edit. n is the shorter word's length, its own or one less; sides
    of at most WHOLE code points aren't halved. Both words have the same key, whichever is the shorter."""
    out, size = [], len(word)
    for n in (size, size - 1):
        for k in places:
            m = n - k - 2  # code points after the bigram in the shorter word
            if m >= 0:
                a = m // 2 if m > WHOLE else 0
                out.append(f"{n}<{k}<{word[: k + 2 + a]}")
                if a:
                    out.append(f"{n}<{k}>{word[: k + 2]}{word[size - m + a :]}")
            m, t = n - size + k, size - k  # those before it, and its distance from the end
            if m >= 0:
                a = m // 2 if m > WHOLE else 0
                out.append(f"{n}>{t}>{word[:a]}{word[k:]}")
                if a:
                    out.append(f"{n}>{t}<{word[k - m + a :]}")
    return out


def keyed(words: DataFrame, counts: dict[str, int]) -> DataFrame:
    """(word, n, pivots, prefix): keys of each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(w, *grams_of(w, counts)) for w in batch.column("word").to_pylist()]
            pivots, prefix = ([_keys(x[0], x[k]) for x in found] for k in (1, 2))
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), *(pa.array(x, pa.list_(pa.string())) for x in (pivots, prefix))], ["word", "n", "pivots", "prefix"])

    return words.mapInArrow(run, "word string, n long, pivots array<string>, prefix array<string>")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n) of all near words, both ways. Words of (word, n), each once, of at least four code points."""
    keys = materialise(keyed(words, gram_counts(words)), "spelling-keys")
    side = lambda c, word, n: keys.select(F.col("word").alias(word), F.col("n").alias(n), F.explode(c).alias("k")).withColumn("k", F.xxhash64("k"))
    near = (F.col("word") != F.col("other")) & (F.abs(F.length("word") - F.length("other")) <= 1) & (F.levenshtein("word", "other", 1) == 1)
    met = side("pivots", "word", "n").join(side("prefix", "other", "other_n"), "k").where(near)
    a, b = F.struct("word", "n"), F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"))
    once = met.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    both = once.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("p"))
    return both.select(F.col("p.x.word").alias("word"), F.col("p.x.n").alias("n"), F.col("p.y.word").alias("other"), F.col("p.y.n").alias("other_n"))


def last_of(links: DataFrame) -> DataFrame:
    """(word, root) of links (word, form): forms followed to the last. The number of rounds is the logarithm of the longest way;
    a form stands at least twice as often as its word, so ways are short and don't return."""
    now = materialise(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        nxt = materialise(now.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        now = nxt.select("word", "root")
        if nxt.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    words = materialise(words_of(docs, id_col, text_col), "spelling-words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other")))
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), F.first("n").alias("own"), best.alias("best"))
    kept = F.col("best.less") <= -2 * F.col("own")
    near = materialise(near.select("word", "n_near", F.when(kept, F.col("best.other")).alias("form"), F.when(kept, -F.col("best.less")).alias("form_n")), "spelling-near")
    roots = last_of(near.where("form IS NOT NULL"))
    out = words.join(near, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
