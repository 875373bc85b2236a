"""Quality classifier: a generalised additive model with pairwise interactions. Each feature of a text is cut into bins; a
lookup table for each feature, and for some pairs of features, says what a bin adds to the log-odds. The tables are
sums of shallow trees, boosted in turn: every round gives each feature, then each pair, one small step down the
gradient, so that features which say the same share the credit.

The model is fitted with numpy on the driver, on a bounded sample of labelled rows (``SAMPLE``): the labels with the
smallest hashes of their doc_id are taken, their features are made by Spark, and only these numbers are collected.
Scoring is one pass in Arrow batches without a shuffle: bins by binary search, then additions of table entries.

Defined cases: a null or empty text has all features 0 and a score like others; labels that are null, or whose document
is missing, teach nothing; a doc_id with several labels or rows counts as often; with labels of one kind only, or none,
the score is their smoothed share (0.5 without any); ties of hashes are taken by doc_id and label; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aridspan.llm.common import blocks, stored, table, texts

#: Labelled rows that the model is fitted on, at most; all of them if there are fewer.
SAMPLE = 20_000
#: Bins of a feature, and of each side of a pair.
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 300, 100, 8
RATE, LEAST_ROWS, SMOOTH = 0.05, 10, 2.0
THRESHOLD = 0.3

FEATURES = (
    "words", "word_length", "long_word", "distinct_words", "repeated_triples", "lines", "line_words", "repeated_lines", "closed_lines",
    "capitals", "capital_words", "digits", "symbols", "marks", "other_bytes", "top_word", "short_lines",
)

CODES = np.arange(256)
IS_CAPITAL = (CODES >= 65) & (CODES <= 90)
IS_DIGIT = (CODES >= 48) & (CODES <= 57)
IS_SMALL = (CODES >= 97) & (CODES <= 122)
IS_BLANK = ((CODES >= 9) & (CODES <= 13)) | (CODES == 32)
IS_MARK = np.isin(CODES, list(b".,;:!?'\"()-"))
IS_SYMBOL = (CODES > 32) & (CODES < 127) & ~(IS_CAPITAL | IS_DIGIT | IS_SMALL | IS_MARK)
KINDS = np.stack([IS_CAPITAL, IS_SMALL, IS_DIGIT, IS_SYMBOL, IS_MARK, (CODES >= 128) & (CODES < 192), CODES >= 192]).astype(np.int64)
CLOSING = b".!?:;,\"')]"


def features(text: bytes | None) -> list[float]:
    """FEATURES of a whole text."""
    words = (text or b"").split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = KINDS @ np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    capital, small, digit, symbol, mark, inner, wide = counts.tolist()
    letters, n = max(1, capital + small + wide), len(words)
    chars = letters + digit + symbol + mark
    times: dict[bytes, int] = {}
    for w in words:
        times[w] = times.get(w, 0) + 1
    triples = set(zip(words, words[1:], words[2:]))
    lines = [x for x in (y.strip() for y in text.split(b"\n")) if x]
    whole = len(lines)
    return [
        np.log1p(n), chars / n, max(map(len, times)), len(times) / n, 1 - len(triples) / max(1, n - 2) if n > 2 else 0.0, np.log1p(whole), n / whole,
        1 - len(set(lines)) / whole, sum(x[-1] in CLOSING for x in lines) / whole, capital / letters, sum(w.isupper() for w in words) / n, digit / chars,
        symbol / chars, mark / chars, wide / letters, max(times.values()) / n, sum(len(x) < 30 for x in lines) / whole,
    ]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    """start (log-odds), the inner edges of each feature's bins, its table, and (i, k, edges of i, edges of k, table) of each pair."""

    start: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for column, edges, held in zip(x.T, self.edges, self.tables):
            out += held[np.searchsorted(edges, column, side="right")]
        for i, k, a, b, held in self.pairs:
            out += held[np.searchsorted(a, x[:, i], side="right"), np.searchsorted(b, x[:, k], side="right")]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.log_odds(x))


def cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner edges of about equally full bins; a value that fills several of them is a bin of its own."""
    found = np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.zeros(0)
    return found[found > values.min()] if len(found) else found


def gain(gradient: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return gradient**2 / (rows + SMOOTH)


def step(gradient: np.ndarray, hessian: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """What one tree of at most four leaves adds to each bin: the best cut, then the best cut of either side."""
    g, h, n = (np.concatenate([[0.0], np.cumsum(x)]) for x in (gradient, hessian, rows))

    def best(low: int, high: int) -> int | None:
        at = np.arange(low + 1, high)
        at = at[(n[at] - n[low] >= LEAST_ROWS) & (n[high] - n[at] >= LEAST_ROWS)]
        if not len(at):
            return None
        return int(at[np.argmax(gain(g[at] - g[low], h[at] - h[low]) + gain(g[high] - g[at], h[high] - h[at]))])

    cuts, first = [0, len(rows)], best(0, len(rows))
    if first is not None:
        cuts += [c for c in (first, best(0, first), best(first, len(rows))) if c is not None]
    cuts.sort()
    value = [-(g[b] - g[a]) / (h[b] - h[a] + SMOOTH) for a, b in zip(cuts, cuts[1:])]
    return np.repeat(value, np.diff(cuts))


def pair_step(gradient: np.ndarray, hessian: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, float]:
    """The same for a grid of bins: the best cut of both sides into four quarters, and its gain over no cut."""
    g, h, n = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (gradient, hessian, rows))
    total, whole, deep = g[-1, -1], h[-1, -1], n[-1, -1]
    inner = (slice(1, -1), slice(1, -1))

    def quarters(x: np.ndarray, all_: float) -> list[np.ndarray]:
        a, top, left = x[inner], x[1:-1, -1:], x[-1:, 1:-1]
        return [a, top - a, left - a, all_ - top - left + a]

    parts = list(zip(quarters(g, total), quarters(h, whole), quarters(n, deep)))
    score = sum(gain(a, b) for a, b, _ in parts)
    allowed = np.all([(c >= LEAST_ROWS) | (c == 0) for _, _, c in parts], axis=0)
    out = np.zeros(rows.shape)
    if not allowed.any():
        return out, 0.0
    score = np.where(allowed, score, -np.inf)
    i, k = np.unravel_index(int(np.argmax(score)), score.shape)
    values = [-a[i, k] / (b[i, k] + SMOOTH) for a, b, _ in parts]
    out[: i + 1, : k + 1], out[: i + 1, k + 1 :], out[i + 1 :, : k + 1], out[i + 1 :, k + 1 :] = values
    return out, float(score[i, k] - gain(np.float64(total), np.float64(whole)))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """The model for rows of features x and labels y (0 or 1)."""
    n_features = len(FEATURES)
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Model(start, [np.zeros(0)] * n_features, [np.zeros(1)] * n_features, [])
    edges = [cut_points(c, BINS) for c in x.T]
    bins = [np.searchsorted(e, c, side="right") for e, c in zip(edges, x.T)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    rows = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, tables)]
    odds = np.full(len(y), start)
    for _ in range(ROUNDS):
        for b, held, n in zip(bins, tables, rows):
            p = sigmoid(odds)
            add = RATE * step(np.bincount(b, p - y, len(held)), np.bincount(b, p * (1 - p), len(held)), n)
            held += add
            odds += add[b]
    coarse = [cut_points(c, PAIR_BINS) for c in x.T]
    cells = [np.searchsorted(e, c, side="right") for e, c in zip(coarse, x.T)]

    def grid(i: int, k: int, weights: np.ndarray | None) -> np.ndarray:
        shape = (len(coarse[i]) + 1, len(coarse[k]) + 1)
        return np.bincount(cells[i] * shape[1] + cells[k], weights, shape[0] * shape[1]).reshape(shape)

    p = sigmoid(odds)
    chosen = [(-pair_step(grid(i, k, p - y), grid(i, k, p * (1 - p)), grid(i, k, None))[1], i, k) for i, k in combinations(range(n_features), 2)]
    chosen = [(i, k) for less, i, k in sorted(chosen)[:PAIRS] if less < 0]
    held = {pair: np.zeros((len(coarse[pair[0]]) + 1, len(coarse[pair[1]]) + 1)) for pair in chosen}
    counts = {pair: grid(*pair, None) for pair in chosen}
    for _ in range(PAIR_ROUNDS):
        for i, k in chosen:
            p = sigmoid(odds)
            add = RATE * pair_step(grid(i, k, p - y), grid(i, k, p * (1 - p)), counts[i, k])[0]
            held[i, k] += add
            odds += add[cells[i], cells[k]]
    return Model(start, edges, tables, [(i, k, coarse[i], coarse[k], held[i, k]) for i, k in chosen])


def featured(docs: DataFrame, carried: list[str]) -> DataFrame:
    """carried columns and x, the features of text."""
    schema = docs.select(*carried).schema.add("x", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            x = pa.array([features(t) for t in texts(block)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in carried), x], schema.names)

    return docs.select(*carried, "text").mapInArrow(run, schema)


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """The model for docs (doc_id, text) and labels (doc_id and a column of 0 and 1), on at most sample labels."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter("doc_id IS NOT NULL AND y IN (0, 1)")
    taken = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample), "quality-labels")
    rows = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id").select("doc_id", "y", "text")
    found = featured(rows, ["doc_id", "y"]).orderBy("doc_id", "y", "x").select("y", "x").toArrow()
    x = np.array(found.column("x").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    return fit(x, np.asarray(found.column("y"), dtype=float))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score (0 to 1, higher: label 1 is likelier), predicted for each row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            x = np.array([features(t) for t in texts(block)]).reshape(-1, len(FEATURES))
            scores = model.scores(x)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    model = fit_quality(docs, labels.filter(~held_out()))
    return score(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")
