"""Language identification: the mean of hashed subword embeddings goes into a linear softmax. Both are
trained by stochastic gradient descent in numpy on a bounded sample; scores are calibrated on rows left
out of training, and so is the surety under which a prediction is rejected: the sum of its two highest scores, so
that a text in two learned languages stays (mixtures of two calibration rows calibrate it as well). Of two
languages that sum is always 1; there the higher score is the surety, and an even mixture of both cannot be told
from a text in neither. One language alone cannot be rejected.

A mean of embeddings followed by a linear layer is linear in the subword counts, so for predictions the
two are multiplied out into one table of logits by bucket (fixed size: buckets x languages), which is
what the tasks get. Prediction is one pass in Arrow batches over whole texts, without a shuffle.

Defined cases: a null text, or one without a letter, is predicted ``und`` with score 0 and rejected;
where nothing can be learned (no labelled rows) every row is; rows without doc_id are predicted but not
learned from; repeated rows are each predicted alone; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan.llm.common import blocks, table, texts

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"

#: Buckets of subwords, embedding size, passes over the sample, step size.
BUCKETS, SIZE, EPOCHS, RATE = 1 << 17, 16, 6, 0.5
#: The most that a step may move a text's own logits for each unit of their error.
STEP = 8.0
#: The sample for training: about so many documents of a language, of at most so many characters.
SAMPLE, SAMPLE_CHARS = 1_500, 20_000
#: The share of rightly predicted calibration rows that may be rejected, and how many standard deviations below the mean
#: a normal distribution has that share: rows fewer than 1 / LOST do not show the quantile themselves.
LOST, DEVIATIONS = 0.0005, 3.2905

LETTER = re.compile(r"[^\W\d_]")
#: ASCII bytes other than letters part words.
PARTS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def subwords(text: bytes) -> np.ndarray:
    """Buckets of the 3- and 4-byte subwords of lower-cased words, word ends included as spaces."""
    low = text.decode().lower().encode().translate(PARTS)
    b = np.frombuffer(b" " + low + b" ", np.uint8).astype(np.uint32)
    three = b[:-2] * np.uint32(65_599) + b[1:-1] * np.uint32(257) + b[2:]
    four = three[:-1] * np.uint32(131) + b[3:] + np.uint32(7)
    inner = b[1:-1] != 32
    keys = np.concatenate([three[inner], four[inner[:-1] & inner[1:]]])
    keys *= np.uint32(0x9E3779B1)
    return (keys >> np.uint32(15)).astype(np.int32)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def surety(p: np.ndarray) -> np.ndarray:
    """Log-odds of the sum of the two highest of more than two probabilities, else of the highest."""
    p = np.sort(p, -1)
    rest = p[:, :-2].sum(1) if p.shape[1] > 2 else p[:, :-1].sum(1)
    return np.log1p(-np.minimum(rest, 1 - 1e-15)) - np.log(np.maximum(rest, 1e-300))


def least_surety(right: np.ndarray) -> float:
    """The LOST quantile of sureties; of few of them, also that of their normal distribution, if it is lower."""
    if not len(right):
        return -np.inf
    found = np.quantile(right, LOST)
    return float(found if len(right) * LOST >= 1 else min(found, right.mean() - DEVIATIONS * right.std()))


@dataclass
class Model:
    languages: list[str]
    logits: np.ndarray  # buckets x languages
    heat: float  # the logits are divided by it
    least: float  # a lower surety is rejected

    def scores(self, batch: list[bytes | None]) -> list[tuple[str, float, bool]]:
        """(language, score, rejected) of each text."""
        out = [("und", 0.0, True)] * len(batch)
        rows = [i for i, t in enumerate(batch) if t is not None and LETTER.search(t.decode())]
        if not self.languages or not rows:
            return out
        means = []
        for i in rows:
            keys = subwords(batch[i])
            total = sum(
                (self.logits[keys[at : at + 100_000]].sum(0, dtype=np.float64) for at in range(0, len(keys), 100_000)),
                np.zeros(len(self.languages)),
            )
            means.append(total / max(1, len(keys)))
        p = softmax(np.asarray(means) / self.heat)
        for i, k, x, low in zip(rows, p.argmax(1).tolist(), p.max(1).tolist(), (surety(p) < self.least).tolist()):
            out[i] = (self.languages[k], min(1.0, x), low)
        return out


def train(rows: list[tuple[str, str, bool]], seed: int = 7) -> Model:
    """rows: text, language, whether for calibration. Few rows are both trained and calibrated on."""
    languages = sorted({r[1] for r in rows})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), 1.0, 1.0)
    rng = np.random.default_rng(seed)
    table_ = (rng.random((BUCKETS, SIZE), np.float32) - 0.5) / SIZE
    weights = np.zeros((SIZE, len(languages)), np.float32)
    fit = []
    for text, language, _ in [r for r in rows if not r[2]] or rows:
        keys, n = np.unique(subwords(text.encode()), return_counts=True)
        if len(keys):
            fit.append((keys, (n / n.sum()).astype(np.float32), languages.index(language)))
    steps = max(1, EPOCHS * len(fit))
    done = 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(fit)):
            keys, share, y = fit[i]
            rate = np.float32(RATE * (1 - done / steps) * SIZE)
            done += 1
            v = share @ table_[keys]
            wrong = softmax(v @ weights)
            wrong[y] -= 1
            # a step that moves this text's own logits too far would be answered by a longer one: texts of one word diverge
            rate = min(rate, np.float32(STEP / (v @ v + share @ share * np.square(weights).sum() + 1e-12)))
            back = weights @ wrong
            weights -= rate * np.outer(v, wrong)
            table_[keys] -= rate * (share[:, None] * back)
    model = Model(languages, table_ @ weights, 1.0, 0.0)
    check = [r for r in rows if r[2]] or rows
    logit = np.asarray(
        [model.logits[k].mean(0) if len(k := subwords(t.encode())) else np.zeros(len(languages)) for t, _, _ in check]
    )
    truth = np.asarray([languages.index(y) for _, y, _ in check])
    at = np.arange(len(check))
    # as Platt's targets: few rows that are all predicted rightly are no reason for certainty
    sure = (len(check) + 1) / (len(check) + len(languages))
    goal = np.full(logit.shape, (1 - sure) / max(1, len(languages) - 1))
    goal[at, truth] = sure
    heats = np.geomspace(0.05, 20, 60)
    model.heat = float(min(heats, key=lambda h: -(goal * np.log(softmax(logit / h) + 1e-300)).sum(1).mean()))
    p = softmax(logit / model.heat)
    model.least = least_surety(surety(p)[p.argmax(1) == truth])
    if len(languages) > 2:  # even mixtures of two rows in two languages, so that such texts stay as often as others
        other = rng.permutation(len(check))
        two = truth != truth[other]
        p = softmax((logit[two] + logit[other][two]) / 2 / model.heat)
        found = np.sort(np.argsort(p, 1)[:, -2:], 1) == np.sort(np.stack([truth[two], truth[other][two]], 1), 1)
        model.least = min(model.least, least_surety(surety(p)[found.all(1)])) if found.all(1).any() else model.least
    return model


def fit_languages(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Trains on about sample documents of each language, drawn by a hash of doc_id from rows that are
    labelled and not held out; a fifth of them calibrates. Texts of over SAMPLE_CHARS characters count only where a
    language has fewer than sample others, and then by their first SAMPLE_CHARS characters."""
    known = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    short = F.char_length("text") <= SAMPLE_CHARS
    share, fits = F.lit(0.0), short
    for lang, n, n_short in known.groupBy("lang").agg(F.count("*"), F.count_if(short)).collect():
        own, few = F.col("lang") == lang, n_short < sample
        share = F.when(own, F.lit(min(1.0, sample / (n if few else n_short)) * 1e6)).otherwise(share)
        fits = fits | own if few else fits
    rows = (
        known.filter((drawn < share) & fits)
        .select(F.substring("text", 1, SAMPLE_CHARS), "lang", (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(5)) == 0).alias("check"), "doc_id")
        .collect()
    )
    return train([(r[0], r[1], r[2]) for r in sorted(rows, key=lambda r: (r[3], r[0])) if LETTER.search(r[0])])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """SCHEMA for each row of docs (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", 1 << 20):
            got = list(zip(*shared.value.scores(texts(block))))
            kinds = [pa.string(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("held_out"), *(pa.array(c, k) for c, k in zip(got, kinds))],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text", held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(run, SCHEMA)


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs (text and any other columns, which stay as they are) whose language is not rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", 1 << 20):
            yield block.filter(pa.array([not r for _, _, r in shared.value.scores(texts(block))]))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit_languages(docs))
