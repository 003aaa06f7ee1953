"""Quality classifier by positive-unlabelled learning (operator 1).

Trusted positives are labelled rows; everything without a label is unlabelled
web text.  The class prior of the unlabelled text is estimated from how far a
first positive-against-unlabelled score separates the two.  The classifier
minimises the non-negative unbiased risk: the positives' risk weighted by the
prior, plus the unlabelled text's negative risk less the positives' share of
it, which is held at or above zero.
"""

from __future__ import annotations

import functools
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import blocks_of, held_out, prepare

#: Rows of trusted positives and of unlabelled texts that are fitted on, and characters of such a row.
FIT_ROWS, FIT_CHARS = 4000, 20_000
HIDDEN = 16
_UPPER = re.compile(r"[^\W\d_a-zß-öø-ÿ]")
NAMES = ("log_words", "word_length", "long_words", "short_words", "distinct", "top_word", "adjacent", "repeat3",
         "upper", "digits", "symbols", "exclaim", "stops", "commas", "other", "dup_lines", "line_words", "bars",
         "bytes_per_char", "squeeze")


def describe(text: str) -> list[float]:
    """The features of one whole text."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    chars = len(text)
    counts = Counter(words)
    lower = text.lower()
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    three = Counter(zip(words, words[1:], words[2:]))
    letters = sum(map(len, words))
    upper = sum(a != b for a, b in zip(text, lower)) if len(lower) == chars else 0
    symbols = sum(map(text.count, "#*$%&|<>@~^=+{}[]\\_"))
    punct = [text.count(c) for c in "!.,"]
    raw = text.encode("utf-8", "surrogatepass")
    return [
        np.log1p(n), letters / n, sum(len(w) > 14 for w in words) / n, sum(len(w) < 3 for w in words) / n,
        len(counts) / n, max(counts.values()) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
        sum(c for c in three.values() if c > 1) / max(1, n - 2),
        upper / letters, sum(map(text.count, "0123456789")) / letters, symbols / n, punct[0] / n, punct[1] / n,
        punct[2] / n, sum(map(text.count, "?;:()\"'-/")) / n, 1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(n / max(1, len(lines))), text.count("|") / n, len(raw) / chars, len(zlib.compress(raw, 1)) / len(raw),
    ]


def features(texts: list[str]) -> np.ndarray:
    return np.array([describe(t) for t in texts], np.float64).reshape(-1, len(NAMES))


class Scorer:
    """A network with one hidden layer over standardised features."""

    def __init__(self, mean, spread, weights):
        self.mean, self.spread, self.weights = mean, spread, weights

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        w1, b1, w2, b2 = self.weights
        return np.tanh(z @ w1 + b1) @ w2 + b2

    def __call__(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(features(texts)), -30, 30)))


def class_prior(pos: np.ndarray, unl: np.ndarray, least: float = 0.02, margin: float = 1.0) -> float:
    """Share of positives among the unlabelled, from scores of both.

    The unlabelled text above a score holds at least the prior's share of the
    positives above it, so the smallest ratio of the two tails bounds the
    prior; a margin for the tails' sampling error keeps small tails from
    ruling.
    """
    at = np.quantile(pos, np.linspace(0, 1 - least, 200))
    tail_p = np.array([(pos >= t).mean() for t in at])
    tail_u = np.array([(unl >= t).mean() for t in at])
    err = margin * (np.sqrt(0.25 / max(1, len(pos))) + np.sqrt(0.25 / max(1, len(unl))))
    k = int(np.argmin((tail_u + err) / np.maximum(tail_p, 1e-9)))
    return float(np.clip(tail_u[k] / max(tail_p[k], 1e-9), 0.01, 0.99))


def _fit(x: np.ndarray, pos: np.ndarray, prior: float | None, epochs: int, seed: int, rate: float = 0.01) -> list:
    """Weights that minimise the non-negative risk, or with no prior the plain positive-against-unlabelled loss."""
    rng = np.random.default_rng(seed)
    w = [rng.normal(0, 0.3, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    p, u = np.flatnonzero(pos), np.flatnonzero(~pos)
    step, size = 0, 512
    for _ in range(epochs):
        p, u = rng.permutation(p), rng.permutation(u)
        rounds = max(1, len(u) // size)
        for k in range(rounds):
            bp, bu = p[k * len(p) // rounds:(k + 1) * len(p) // rounds], u[k * len(u) // rounds:(k + 1) * len(u) // rounds]
            if not len(bp) or not len(bu):
                continue
            rows = np.concatenate([bp, bu])
            h = np.tanh(x[rows] @ w[0] + w[1])
            s = 1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -30, 30)))
            sp, su = s[:len(bp)], s[len(bp):]
            # logistic loss: -log s for a positive, -log(1 - s) for a negative
            if prior is None:
                g = np.concatenate([(sp - 1) / len(bp), su / len(bu)])
            else:
                down_p, down_u = -np.log1p(-np.minimum(sp, 1 - 1e-9)), -np.log1p(-np.minimum(su, 1 - 1e-9))
                rest = down_u.mean() - prior * down_p.mean()
                if rest >= 0:
                    g = np.concatenate([prior * (sp - 1) / len(bp) - prior * sp / len(bp), su / len(bu)])
                else:                                   # the negative part has gone below zero: step back from it
                    g = np.concatenate([prior * sp / len(bp), -su / len(bu)])
            back = g[:, None] * w[2] * (1 - h * h)
            grads = [x[rows].T @ back + 1e-4 * w[0], back.sum(0), h.T @ g + 1e-4 * w[2], np.array([g.sum()])]
            step += 1
            for i, gr in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * gr
                v[i] = 0.999 * v[i] + 0.001 * gr * gr
                w[i] = w[i] - rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return w


def train(x: np.ndarray, pos: np.ndarray, seed: int = 5, epochs: int = 40) -> tuple[Scorer, float]:
    """(scorer, estimated class prior) from features of positives (pos) and unlabelled rows."""
    mean, spread = x.mean(0), x.std(0) + 1e-6
    z = np.clip((x - mean) / spread, -8, 8)
    # the prior is read off held-back rows of a first score
    back = np.random.default_rng(seed).random(len(z)) < 0.4
    if not (pos & back).any() or not (~pos & back).any() or not (pos & ~back).any() or not (~pos & ~back).any():
        back[:] = False
    fit_on = ~back
    first = Scorer(mean, spread, _fit(z[fit_on], pos[fit_on], None, max(5, epochs // 4), seed))
    s = first.raw(x)
    see = back if back.any() else fit_on
    prior = class_prior(s[see & pos], s[see & ~pos])
    return Scorer(mean, spread, _fit(z, pos, prior, epochs, seed)), prior


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, max_chars: int = FIT_CHARS,
        id_col: str = "doc_id", text_col: str = "text") -> bytes | None:
    """A trained scorer, pickled, or None without a positive or an unlabelled row.

    Trusted positives: rows labelled 1 outside the held-out fold; unlabelled:
    rows without a label.  At most ``rows`` of each, in the order of a hash of
    the id, of texts of at most ``max_chars`` characters; of several texts
    under an id the smallest counts.  Only features go to the driver.
    """
    text = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("text")) \
        .where("_id IS NOT NULL").where(F.length("text") <= max_chars)
    lab = labels.select(F.col(id_col).alias("_id"), F.col("quality").cast("int").alias("q")).where("_id IS NOT NULL")
    trusted = lab.where(~held_out(F.col("_id"))).groupBy("_id").agg(F.min("q").alias("q")).where("q = 1").select("_id")
    ids = text.select("_id").distinct()
    order = [F.xxhash64("_id"), F.col("_id")]
    pos = ids.join(trusted, "_id", "left_semi").orderBy(*order).limit(rows).withColumn("pos", F.lit(True))
    unl = ids.join(lab, "_id", "left_anti").orderBy(*order).limit(rows).withColumn("pos", F.lit(False))
    sample = text.join(F.broadcast(pos.unionByName(unl)), "_id").groupBy("_id").agg(
        F.min("text").alias("text"), F.first("pos").alias("pos"))

    @F.pandas_udf("array<double>")
    def described(s: pd.Series) -> pd.Series:
        return pd.Series(list(features(list(s))))

    got = sorted(sample.select("_id", "pos", described("text").alias("x")).collect(), key=lambda r: (r[0], r[1], r[2]))
    flag = np.array([r.pos for r in got], bool)
    if not flag.any() or flag.all():
        return None
    return pickle.dumps(train(np.array([r.x for r in got], np.float64), flag))


@functools.lru_cache(maxsize=2)
def _scorer(model: bytes) -> Scorer:
    return pickle.loads(model)[0]


def score(text: Column, model: bytes | None) -> Column:
    """Quality of a whole text, 0 to 1; null and empty texts are scored as texts without words.  Without a model: 1."""
    if model is None:
        return F.lit(1.0)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = _scorer(model)
        for s in batches:
            texts = [t if isinstance(t, str) else "" for t in s]
            parts = [scorer(texts[p]) for p in blocks_of(list(map(len, texts)))]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return run(text)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` by its whole text.

    Repeated rows are scored alike, an empty table gives no rows, and columns
    other than the id and the text are not read.
    """
    prepare(docs.sparkSession)
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       score(F.col(text_col), model).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
