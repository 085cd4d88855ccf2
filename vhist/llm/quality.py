"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text train a logistic model on counts of
character classes by minimising the non-negative unbiased risk

    pi E_p[l(f)] + max(0, E_u[l(-f)] - pi E_p[l(-f)])

with the class prior pi estimated from the labelled training rows.  The
model sees a bounded sample: at most ``SAMPLE`` positives and as many
unlabelled texts, those whose ids' hashes are smallest, from training rows
only.  Features and scores are made of whole texts; labels, lang, source and
doc_id are never inputs.

Defined cases: null and empty texts have all features zero and are scored like
any other; an id labelled both 0 and 1 is not trusted; a row without id is not
held out and never trains; without positives every score is 0.5; repeated rows
are scored each.
"""

from __future__ import annotations

import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vhist.llm.common import batches, filtered, text_rows, words_of

SAMPLE = 5000
STEPS = 600
RATE = 0.05
DECAY = 1e-3

# Character classes: lower, upper, digit, space, line end, sentence mark, comma,
# exclamation, each of # $ % & * | by itself, other ASCII, non-ASCII.
_CLASSES = 16


def _class_table() -> np.ndarray:
    t = np.full(256, 14, np.uint8)
    for k, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".;:?", ",", "!", "#", "$", "%", "&", "*", "|")):
        t[list(chars.encode())] = k
    t[128:] = 15
    return t


_CLASS = _class_table()
N_FIGURES = 6  # of words and lines
N_FEATURES = _CLASSES + _CLASSES * _CLASSES + N_FIGURES


def features(raw: bytes) -> np.ndarray:
    """Square roots of the shares of character classes and of their pairs, and
    figures of words and lines: length, distinct words, word length, words that
    repeat the one before, distinct lines, line length."""
    out = np.zeros(N_FEATURES, np.float32)
    if not raw:
        return out
    c = _CLASS[np.frombuffer(raw, np.uint8)]
    out[:_CLASSES] = np.bincount(c, minlength=_CLASSES) / len(c)
    if len(c) > 1:
        pairs = np.bincount(c[:-1].astype(np.int64) * _CLASSES + c[1:], minlength=_CLASSES * _CLASSES)
        out[_CLASSES:-N_FIGURES] = pairs / (len(c) - 1)
    out = np.sqrt(out)
    words = words_of(raw)
    lines = [x for x in raw.split(b"\n") if x]
    n = max(1, len(words))
    out[-N_FIGURES:] = (
        np.log1p(len(raw)) / 10,
        len(set(words)) / n,
        np.sqrt(len(raw) / n) / 10,
        np.sqrt(sum(map(operator.eq, words, words[1:])) / n),
        len(set(lines)) / max(1, len(lines)),
        np.log1p(len(raw) / max(1, len(lines))) / 10,
    )
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sigmoid(f: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(f, -30, 30)))


def nn_pu(pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = STEPS):
    """Weights and intercept of the minimiser, by full-batch Adam steps."""
    x = np.vstack([pos, unl]).astype(np.float64)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    p = np.c_[(pos - mean) / scale, np.ones(len(pos))]
    u = np.c_[(unl - mean) / scale, np.ones(len(unl))]
    w = np.zeros(p.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        fp, fu = p @ w, u @ w
        # logistic loss: l(f) = log(1 + exp(-f))
        sp, su = _sigmoid(fp), _sigmoid(fu)
        g_pos = prior * (p.T @ (sp - 1)) / len(p)
        rest = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        g_rest = (u.T @ su) / len(u) - prior * (p.T @ sp) / len(p)
        # where the negative risk falls below zero it is overfitted: step back instead
        grad = g_pos + g_rest if rest >= 0 else -g_rest
        grad = grad + DECAY * np.r_[w[:-1], 0.0]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    weights = w[:-1] / scale
    return weights, float(w[-1] - mean @ weights)


def _featured(rows: DataFrame) -> DataFrame:
    def run(parts):
        for kinds, raws in batches(parts, "kind", "raw"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.int32()), pa.array([features(r).tobytes() for r in raws], pa.binary())], names=["kind", "x"]
            )

    return rows.select("kind", "raw").mapInArrow(run, "kind int, x binary")


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """(weights, intercept, prior) from training rows; weights None without positives."""
    marked = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("quality"))
    marked = marked.dropna().filter(~held_out(F.col("doc_id")))
    trusted = marked.groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    counts = trusted.agg(F.count("*").alias("n"), F.coalesce(F.sum("low"), F.lit(0)).alias("good")).first()
    if not counts.good:
        return None, 0.0, 0.5
    prior = (counts.good + 1) / (counts.n + 2)
    by_hash = lambda seed: F.xxhash64(F.lit(seed), F.col("doc_id"))
    docs = text_rows(documents)
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    good = ids.join(trusted.filter("low = 1 and high = 1"), "doc_id", "left_semi")
    picked = (
        good.orderBy(by_hash(1), "doc_id").limit(sample).select("doc_id", F.lit(1).alias("kind"))
        .unionByName(ids.orderBy(by_hash(2), "doc_id").limit(sample).select("doc_id", F.lit(0).alias("kind")))
    ).distinct()
    # one text per id (rows may repeat it): the one of the smallest hash; at most 2 x sample ids
    texts = docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "kind").agg(F.min_by("raw", F.struct(F.xxhash64("raw"), "raw")).alias("raw"))
    rows = _featured(texts).collect()
    x = {k: np.array([np.frombuffer(bytes(r.x), np.float32) for r in rows if r.kind == k]) for k in (0, 1)}
    if not len(x[1]) or not len(x[0]):
        return None, 0.0, prior
    weights, intercept = nn_pu(x[1], x[0], prior)
    return weights, intercept, prior


def _scores(raws: list[bytes], weights, intercept: float) -> np.ndarray:
    if weights is None:
        return np.full(len(raws), 0.5)
    f = np.array([float(features(r).astype(np.float64) @ weights) for r in raws]) + intercept
    return 1 / (1 + np.exp(-np.clip(f, -500, 500)))


def good_documents(documents: DataFrame, columns: list[str], weights, intercept: float) -> DataFrame:
    """The named columns of the documents with a score of at least 0.5, left where they are."""
    return filtered(documents, columns, lambda raws: (_scores(raws, weights, intercept) >= 0.5).tolist())


def score(documents: DataFrame, weights, intercept: float) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""

    def run(parts):
        for ids, raws in batches(parts, "doc_id", "raw"):
            s = _scores(raws, weights, intercept)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())],
                names=["doc_id", "score", "predicted"],
            )

    scored = text_rows(documents).mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def quality_scores(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    weights, intercept, _ = fit(documents, labels, sample)
    return score(documents, weights, intercept)
