"""A quality classifier from positive and unlabelled rows.

Trusted positives (label 1) and unlabelled web text are all that the fit sees. With the class prior pi
the unbiased risk is pi R_p(+) + [R_u(-) - pi R_p(-)]; the bracket estimates the negatives' risk and is
held at 0 or more (non-negative risk): where it falls below, the step goes the other way. Under the
logistic loss the sigmoid of the learned function estimates P(1 | text).

The prior comes from positives and unlabelled rows alone: above any threshold t of a score the share of
unlabelled rows is at least pi times the share of positives, so that the quotient of both shares bounds pi
from above. Two first models with an even prior, each fitted on half the rows, score each other's rows; the
threshold is that at which the quotient and its sampling error are least (best bin estimation). Rows labelled
0 are never used.

Features come from the text alone: shares of byte classes and of each punctuation sign, lengths, and
repetition of words, word runs and lines.

Defined results: null and empty texts get the features of an empty text and so a score; repeated rows
are answered each; without positives or unlabelled rows every score is 1; a text of any length is read
whole; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import id_and_text, rows_where, slices, texts
from tidewell.llm.textwords import NOT_SPACE, windows, words
from tidewell.session import ready

POSITIVES, UNLABELLED = 8_000, 16_000  # rows fitted on, in expectation; all if there are fewer
PUNCTUATION = [b for b in range(33, 127) if not chr(b).isalnum()]
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_CLASSES = {**{f"sign_{chr(b)}": np.arange(256) == b for b in PUNCTUATION}, "upper": _UPPER, "lower": np.array([97 <= b <= 122 for b in range(256)]), "digit": np.array([48 <= b <= 57 for b in range(256)]), "high": np.arange(256) >= 128, "line": np.arange(256) == 10, "control": (np.arange(256) < 32) & (np.arange(256) != 10)}
_TABLE = np.array(list(_CLASSES.values()), np.float64).T
NAMES = [*_CLASSES, "log_bytes", "log_words", "word_bytes", "distinct_words", "distinct_pairs", "distinct_triples", "next_same", "second_same", "distinct_lines", "shout_words"]


def _share_distinct(x: np.ndarray) -> float:
    return len(np.unique(x)) / len(x) if len(x) else 1.0


def features(raw: list[bytes | None]) -> np.ndarray:
    """A row of NAMES for each text."""
    found = words(raw, NOT_SPACE)
    pairs, triples = windows(found.hashes, 2), windows(found.hashes, 3)
    out = np.zeros((len(raw), len(NAMES)))
    for k, text in enumerate(raw):
        text = text or b""
        a, b = found.first[k], found.first[k + 1]
        n, own = b - a, found.hashes[a:b]
        shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _TABLE / max(1, len(text))
        lines = text.split(b"\n")
        distinct = _share_distinct(own)
        out[k] = [
            *shares,
            np.log1p(len(text)),
            np.log1p(n),
            min(40.0, len(text) / max(1, n)),
            distinct,
            _share_distinct(pairs[a : max(a, b - 1)]),
            _share_distinct(triples[a : max(a, b - 2)]),
            float((own[1:] == own[:-1]).mean()) if n > 1 else 0.0,
            float((own[2:] == own[:-2]).mean()) if n > 2 else 0.0,
            len(set(lines)) / len(lines),
            shares[len(PUNCTUATION)] / max(1e-9, shares[len(PUNCTUATION)] + shares[len(PUNCTUATION) + 1]),
        ]
    return out


class Model:
    """Two layers on standardised features."""

    def __init__(self, positives: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 24, steps: int = 600, rate: float = 0.01, decay: float = 1e-4, seed: int = 7):
        self.prior, self.weights = prior, None
        if not len(positives) or not len(unlabelled):
            return
        self.centre = unlabelled.mean(0)
        self.scale = np.maximum(unlabelled.std(0), 1e-3)
        xp, xu = self._standard(positives), self._standard(unlabelled)
        rng = np.random.default_rng(seed)
        w = [rng.normal(0, 1 / np.sqrt(xp.shape[1]), (xp.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
        m, v = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
        x = np.concatenate([xp, xu])
        n = len(xp)
        for step in range(1, steps + 1):
            h = np.tanh(x @ w[0] + w[1])
            g = h @ w[2] + w[3]
            p = 1 / (1 + np.exp(-g))
            negative = np.logaddexp(0, g[n:]).mean() - prior * np.logaddexp(0, g[:n]).mean()
            d = np.empty(len(x))
            if negative >= 0:
                d[:n] = prior / n * ((p[:n] - 1) - p[:n])
                d[n:] = p[n:] / len(xu)
            else:  # the negatives' risk can't be below 0: a step against its descent
                d[:n] = prior / n * p[:n]
                d[n:] = -p[n:] / len(xu)
            dh = d[:, None] * w[2] * (1 - h * h)
            grads = [x.T @ dh + decay * w[0], dh.sum(0), h.T @ d + decay * w[2], np.array([d.sum()])]
            for k, q in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * q
                v[k] = 0.999 * v[k] + 0.001 * q * q
                w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self.weights = w

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -6, 6)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        w = self.weights
        return 1 / (1 + np.exp(-(np.tanh(self._standard(x) @ w[0] + w[1]) @ w[2] + w[3])))


def class_prior(x: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, steps: int = 200, error: float = 0.1, slack: float = 0.01) -> float:
    """The share of positives among the unlabelled rows of x, in an order that says nothing. A row may be marked as both. 1 if there are too few."""
    half = np.arange(len(x)) % 2  # a row marked twice is on one side
    if any(not (mark & (half == k)).any() for mark in (positive, unlabelled) for k in (0, 1)):
        return 1.0
    scores = np.empty(len(x))
    for k in (0, 1):
        scores[half != k] = Model(x[positive & (half == k)], x[unlabelled & (half == k)], 0.5, steps=steps).score(x[half != k])
    p, u = np.sort(scores[positive]), np.sort(scores[unlabelled])
    above_p = 1 - np.arange(len(p)) / len(p)
    above_u = 1 - np.searchsorted(u, p) / len(u)
    spread = sum(np.sqrt(np.log(4 / error) / (2 * n)) for n in (len(p), len(u)))
    best = np.argmin((above_u + (1 + slack) * spread) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 1.0))


def fit(docs: DataFrame, labels: DataFrame, fold: Column, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Fits on rows of docs where `fold` (a condition on id_col) holds. An id with several labels counts with its lowest."""
    ready(docs.sparkSession)
    known = labels.where(fold).groupBy(F.col(f"`{id_col}`").cast("long").alias("p_id")).agg(F.min(label_col).alias("label")).where("p_id IS NOT NULL AND label IS NOT NULL")
    ones = known.where("label = 1").count()
    place = lambda c, salt: F.pmod(F.xxhash64(c.cast("long"), F.lit(salt)), F.lit(1 << 20))
    keep_p = int(min(1.0, positives / max(1, ones)) * (1 << 20))
    total = docs.count()
    keep_u = int(min(1.0, unlabelled / max(1, total)) * (1 << 20))
    trusted = known.where((F.col("label") == 1) & (place(F.col("p_id"), 1) < keep_p)).select("p_id")  # about `positives` rows at most
    drawn = id_and_text(docs.where(fold), id_col, text_col).join(F.broadcast(trusted), F.col("id") == F.col("p_id"), "left")
    drawn = drawn.withColumns({"p": F.col("p_id").isNotNull(), "u": F.coalesce(place(F.col("id"), 2) < keep_u, F.lit(False))}).where("p OR u")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 19):
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("p"), batch.column("u"), pa.array(features(texts(batch)).tolist(), pa.list_(pa.float64()))], ["id", "p", "u", "x"])

    rows = drawn.select("id", "text", "p", "u").mapInArrow(run, "id long, p boolean, u boolean, x array<double>").toPandas()
    rows = rows.sort_values("id", kind="stable")  # the same model whatever order rows came in
    x = np.array(rows["x"].tolist()).reshape(-1, len(NAMES))
    p, u = rows["p"].to_numpy(bool), rows["u"].to_numpy(bool)
    return Model(x[p], x[u], class_prior(x, p, u))


def score(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """Per row: id, score (P(1 | text)), predicted (1 from the threshold on), and `more`."""
    spark = ready(docs.sparkSession)
    names = list(more)
    held = spark.sparkContext.broadcast(model)  # a few thousand numbers
    kept = id_and_text(docs, id_col, text_col, **more)
    schema = ", ".join([f"`{id_col}` long", "score double", "predicted int", *(f"`{k}` {kept.schema[k].dataType.simpleString()}" for k in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 19):
            s = held.value.score(features(texts(batch)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(s), pa.array((s >= threshold).astype(np.int32)), *(batch.column(k) for k in names)], [id_col, "score", "predicted", *names])

    return kept.mapInArrow(run, schema)


def good(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """docs whose score is at least the threshold."""
    held = ready(docs.sparkSession).sparkContext.broadcast(model)
    return rows_where(docs, lambda raw: held.value.score(features(raw)) >= threshold, text_col)
