"""Toxic spans by a linear-chain conditional random field (operator 8).

Tokens are labelled from the documents' labels: a token of a toxic document is
toxic if its word, or the beginning of its word, occurs in toxic documents and
hardly ever in others.  A two-state linear-chain CRF is trained on these
labelled tokens; forward-backward marginals of a text's tokens give its
offending spans and, through a small calibrated map, its score.
"""

from __future__ import annotations

import functools
import hashlib
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import blocks_of, columns_of, fresh, held_out, prepare, stored, train_rows

TOKEN = re.compile(r"[^\W_]+")
#: Rows of each label value that the field is fitted on, and characters of a row.
TRAIN_ROWS, TRAIN_CHARS = 600, 6_000
#: Rows of each label value from which tokens are labelled.
LABEL_ROWS = 5_000
#: Tokens of the texts that the recursions hold at once while the field is fitted.
TRAIN_BLOCK = 50_000
#: Tokens that the recursions walk in step.
CHUNK = 64
#: Entries of a worker's cache of emissions; it is emptied when full.
CACHE = 500_000
#: A token's marginal from which it belongs to an offending span.
SPAN = 0.5


def features(word: str) -> tuple[str, ...]:
    """Observation features of one token: the word, its beginnings and its end."""
    return ("w:" + word, "3:" + word[:3], "4:" + word[:4], "5:" + word[:5], "6:" + word[:6], "e:" + word[-3:],
            f"n:{min(len(word), 12)}")


def token_labels(texts: list[list[str]], toxic: np.ndarray, evidence: float = 12.0, lead: float = 0.3) -> set[str]:
    """Features (words and beginnings of words) that mark a token as toxic.

    A feature marks if most of the texts that have it are toxic and that
    can't be chance: the log-likelihood ratio against the share of toxic texts
    is over ``evidence``.  Markers are taken in rounds, each time those with
    at least ``lead`` of the best ratio; texts that hold two marked tokens are
    explained then and lend no more evidence, so that words which only happen
    to stand beside markers (in copies, say) get none.
    """
    good = [set(w) for w, t in zip(texts, toxic) if not t]
    bad = {" ".join(w): w for w, t in zip(texts, toxic) if t}        # copies of a text count once
    left = [(list(w), set(w)) for w in bad.values()]
    n1, n0 = len(left), len(good)
    if not n1 or not n0:
        return set()
    first = Counter(f for _, s in left for f in {f for w in s for f in features(w)[:5] if len(f) >= 6})
    against = Counter(f for s in good for f in {f for w in s for f in features(w)[:5]} if first[f] > 2)
    share = n1 / (n1 + n0)
    out: set[str] = set()
    while left:
        seen = Counter(f for _, s in left for f in {f for w in s for f in features(w)[:5] if first[f] > 2})
        ratio = {}
        for f, k in seen.items():
            n = k + against[f]
            p = min(k / n, 1 - 1e-9)
            if p > max(0.5, share) and f not in out:
                r = k * np.log(p / share) + (n - k) * np.log((1 - p) / (1 - share))
                if r > evidence:
                    ratio[f] = r
        if not ratio:
            return out
        best = max(ratio.values())
        out |= {f for f, r in ratio.items() if r >= lead * best}
        rest = []
        for words, s in left:
            marked = {w for w in s if any(f in out for f in features(w)[:5])}
            if sum(w in marked for w in words) < 2:
                rest.append((words, s))
        left = rest
    return out


class Field:
    """Weights of the two-state CRF over the features that the training tokens have."""

    def __init__(self, weights: dict[str, float], trans: np.ndarray, begin: np.ndarray, bias: float, scale: np.ndarray):
        self.weights, self.trans, self.begin, self.bias, self.scale = weights, trans, begin, bias, scale
        self.cache: dict[str, float] = {}

    def emission(self, word: str) -> float:
        get = self.weights.get
        return self.bias + sum(get(f, 0.0) for f in features(word))

    def emissions(self, words: list[str]) -> np.ndarray:
        new = set(words) - self.cache.keys()
        if len(self.cache) + len(new) > CACHE:
            self.cache.clear()
            new = set(words)
        self.cache.update((w, self.emission(w)) for w in new)
        return np.array([self.cache[w] for w in words])


def marginals(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(p(state 1) of every token, expected transitions [2, 2] summed over all texts).

    ``emit`` has the log potential of state 1 over state 0 of the tokens of
    all texts in a row.  Texts are cut into chunks that are walked in step as
    products of 2 x 2 matrices; a scan over each text's chunks then gives the
    messages at their borders, so the result is that of the plain recursion.
    """
    total = int(lengths.sum())
    if not total:
        return np.zeros(0), np.zeros((2, 2))
    per = -(-lengths // CHUNK)
    texts = np.flatnonzero(per)
    first_tok = np.cumsum(lengths) - lengths
    chunk_text = np.repeat(np.arange(len(lengths)), per)
    first_chunk = np.cumsum(per) - per
    nth = np.arange(len(chunk_text)) - first_chunk[chunk_text]
    at = first_tok[chunk_text] + nth * CHUNK
    size = np.minimum(CHUNK, lengths[chunk_text] - nth * CHUNK)
    order = np.argsort(-size, kind="stable")              # chunks that still run stand first
    at, size = at[order], size[order]
    live = np.array([(size > k).sum() for k in range(CHUNK)])
    pot = np.exp(np.clip(np.stack([np.zeros(total), emit]), -30, 30))   # [state, token]
    t = np.exp(trans)
    # a text begins with the message (1, 1), so its first potential takes the place of the step into it
    heads = first_tok[lengths > 0]
    pot[:, heads] *= (np.exp(begin) / t.sum(0))[:, None]
    # prefix[i, j]: weight of arriving in state j at a token from message i before its chunk
    prefix = np.zeros((total, 2, 2))
    cur = np.broadcast_to(np.eye(2), (len(at), 2, 2)).copy()
    for k in range(CHUNK):
        n = live[k]
        if not n:
            break
        tok = at[:n] + k
        step = (cur[:n] @ t) * pot[:, tok].T[:, None, :]
        step /= step.sum((1, 2), keepdims=True)
        cur[:n] = step
        prefix[tok] = step
    suffix = np.zeros((total, 2, 2))
    back = np.broadcast_to(np.eye(2), (len(at), 2, 2)).copy()
    for k in range(CHUNK - 1, -1, -1):
        n = live[k]
        if not n:
            continue
        tok = at[:n] + k
        suffix[tok] = back[:n]                             # from this token's state to the message after the chunk
        step = t @ (pot[:, tok].T[:, :, None] * back[:n])
        step /= step.sum((1, 2), keepdims=True)
        back[:n] = step
    whole = np.empty_like(cur)
    whole[order] = cur
    whole_back = np.empty_like(back)
    whole_back[order] = back
    # messages at chunk borders: one step for each chunk number, over all texts that have it
    ahead = np.zeros((len(chunk_text), 2))
    after = np.ones((len(chunk_text), 2))
    msg = np.ones((len(lengths), 2))
    for k in range(int(per.max())):
        has = texts[per[texts] > k]
        c = first_chunk[has] + k
        ahead[c] = msg[has]
        m = np.einsum("ni,nij->nj", msg[has], whole[c])
        msg[has] = m / m.sum(1, keepdims=True)
    msg = np.ones((len(lengths), 2))
    for k in range(int(per.max()) - 1, -1, -1):
        has = texts[per[texts] > k]
        c = first_chunk[has] + k
        after[c] = msg[has]
        m = np.einsum("nij,nj->ni", whole_back[c], msg[has])
        msg[has] = m / m.sum(1, keepdims=True)
    chunk_of = np.repeat(np.arange(len(chunk_text)), np.minimum(CHUNK, lengths[chunk_text] - nth * CHUNK))
    alpha = np.einsum("ni,nij->nj", ahead[chunk_of], prefix)
    beta = np.einsum("nij,nj->ni", suffix, after[chunk_of])
    both = alpha * beta
    p = both[:, 1] / both.sum(1)
    # pairs of neighbouring tokens of one text
    pair = np.ones(total, bool)
    pair[first_tok[lengths > 0]] = False
    i = np.flatnonzero(pair)
    xi = alpha[i - 1][:, :, None] * t * (pot[:, i].T * beta[i])[:, None, :]
    xi /= xi.sum((1, 2), keepdims=True)
    return p, xi.sum(0)


def summaries(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per text: largest marginal, second largest, log of one plus the expected number of toxic tokens."""
    out = np.zeros((len(lengths), 3))
    full = np.flatnonzero(lengths)
    if len(full):
        at = (np.cumsum(lengths) - lengths)[full]
        out[full, 0] = np.maximum.reduceat(p, at)
        out[full, 2] = np.log1p(np.add.reduceat(np.where(p > 0.01, p, 0), at))
        rest = p.copy()
        owner = np.repeat(np.arange(len(lengths)), lengths)
        top = np.flatnonzero(p == out[owner, 0])
        rest[top[np.unique(owner[top], return_index=True)[1]]] = 0
        out[full, 1] = np.maximum.reduceat(rest, at)
    return out


def _lower_words(text: str) -> list[str]:
    """The tokens of a text, cut before they are lower-cased."""
    return [w.lower() for w in TOKEN.findall(text)]


def train_field(texts: list[str], toxic: np.ndarray, marks: set[str] | None = None, rows: int = TRAIN_ROWS,
                rounds: int = 40, rate: float = 0.5, l2: float = 1e-5) -> Field:
    """Fit the CRF by gradient ascent of the conditional likelihood of the labelled tokens.

    A token of a toxic text is toxic if it has one of ``marks`` (by default
    those of these texts); the field is fitted on the first ``rows`` of each
    label.  The recursions walk blocks of texts, so that their arrays stay
    small however many texts there are.
    """
    if marks is None:
        marks = token_labels([_lower_words(t) for t in texts], toxic)
    use = np.sort(np.concatenate([np.flatnonzero(toxic == v)[:rows] for v in (0, 1)]))
    toxic = toxic[use]
    vocab: dict[str, int] = {}
    split = []
    for i in use:
        split.append(np.array([vocab.setdefault(w, len(vocab)) for w in _lower_words(texts[i])], np.int32))
    lengths = np.array(list(map(len, split)), np.int64)
    word_of = np.concatenate(split).astype(np.int64) if split else np.zeros(0, np.int64)
    # features of fewer than three texts share one weight, which stays zero
    feats: dict[str, int] = {"": 0}
    rows = np.array([[feats.setdefault(f, len(feats)) for f in features(w)] for w in vocab], np.int64).reshape(-1, 7)
    docs_with = np.zeros(len(feats), np.int64)
    for s in split:
        docs_with[np.unique(rows[np.unique(s)])] += 1
    rows[docs_with[rows] < 3] = 0
    marked = np.array([any(f in marks for f in features(w)[:5]) for w in vocab], bool)
    y = marked[word_of] & np.repeat(toxic.astype(bool), lengths) if len(word_of) else np.zeros(0, bool)
    n = max(1, len(y))
    w, bias = np.zeros(len(feats)), -3.0
    trans, begin = np.zeros((2, 2)), np.zeros(2)
    first = np.cumsum(lengths) - lengths
    inner = np.ones(len(y), bool)
    inner[first[lengths > 0]] = False
    i = np.flatnonzero(inner)
    want = np.zeros((2, 2))
    np.add.at(want, (y[i - 1].astype(int), y[i].astype(int)), 1)
    parts = list(blocks_of(lengths.tolist(), TRAIN_BLOCK))

    def walk(emission: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """(tokens, their texts' lengths, marginals, expected transitions) of each block of texts."""
        for part in parts:
            at = slice(int(first[part.start]), int(first[part.stop - 1] + lengths[part.stop - 1]))
            p, xi = marginals(emission[word_of[at]], lengths[part], trans, begin)
            yield at, lengths[part], p, xi

    # ascent with a step per weight (accumulated squares)
    acc_w, acc_t, acc_b = np.full(len(feats), 1e-8), np.full((2, 2), 1e-8), 1e-8
    for _ in range(rounds if len(y) else 0):
        miss, got, over = np.zeros(len(vocab)), np.zeros((2, 2)), 0.0
        for at, _, p, xi in walk(w[rows].sum(1) + bias):
            off = y[at] - p
            miss += np.bincount(word_of[at], off, minlength=len(vocab))
            got += xi
            over += float(off.sum())
        g = np.bincount(rows.ravel(), np.repeat(miss, rows.shape[1]), minlength=len(feats)) / n - l2 * w
        g[0] = 0.0
        gt = (want - got) / n - l2 * trans
        gb = over / n
        acc_w += g * g
        acc_t += gt * gt
        acc_b += gb * gb
        w += rate * g / np.sqrt(acc_w)
        trans += 0.2 * rate * gt / np.sqrt(acc_t)
        bias += rate * gb / np.sqrt(acc_b)
    # calibration of the documents' summaries by logistic regression
    found = [summaries(p, size) for _, size, p, _ in walk(w[rows].sum(1) + bias)] if len(lengths) else []
    x = np.concatenate([np.concatenate(found), np.ones((len(lengths), 1))], axis=1) if found else np.zeros((0, 4))
    c, acc = np.zeros(4), np.full(4, 1e-8)
    for _ in range(400):
        g = x.T @ (toxic - 1 / (1 + np.exp(-x @ c))) / max(1, len(x)) - 1e-4 * c
        acc += g * g
        c += 0.5 * g / np.sqrt(acc)
    keep = {f: float(w[k]) for f, k in feats.items() if abs(w[k]) > 0.1}
    return Field(keep, trans, begin, bias, c)


def _marking(words: list[str]) -> set[str]:
    """The features of a text that may mark: words of four letters or more, beginnings of four or more."""
    return {f for w in set(words) for f in features(w)[:5] if len(f) >= 6}


def marks_of(sample: DataFrame, evidence: float = 12.0, lead: float = 0.3) -> set[str]:
    """:func:`token_labels` of a table (text, label), counted in Spark.

    Each task counts the features of its texts; a round brings only the
    features over the evidence to the driver, and the texts stay where they are.
    """
    spark = prepare(sample.sparkSession)

    @F.pandas_udf("string")
    def copy(text: pd.Series) -> pd.Series:
        return pd.Series([hashlib.sha256(" ".join(_lower_words(t)).encode("utf-8", "surrogatepass")).hexdigest()
                          for t in text])

    bad = stored(sample.where("label = 1").select("text", copy("text").alias("copy"))
                 .groupBy("copy").agg(F.min("text").alias("text")).drop("copy"), "crf-toxic")
    good = sample.where("label = 0").select("text")
    n1, n0 = bad.count(), good.count()
    if not n1 or not n0:
        return set()

    def counted(known: set[str]):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            got: Counter = Counter()
            for b in batches:
                for t in b["text"]:
                    words = _lower_words(t)
                    if known:
                        # a text with two marked tokens is explained
                        mine = {w for w in set(words) if any(f in known for f in features(w)[:5])}
                        if sum(w in mine for w in words) >= 2:
                            continue
                    got.update(_marking(words))
            if got:                                           # a frame without rows has no column of text
                yield pd.DataFrame({"f": list(got.keys()), "n": list(got.values())})
        return run

    first = bad.mapInPandas(counted(set()), "f string, n bigint").groupBy("f").agg(F.sum("n").alias("n")).where("n > 2")
    against = good.mapInPandas(counted(set()), "f string, n bigint").groupBy("f").agg(F.sum("n").alias("against"))
    may = stored(first.join(against, "f", "left").select("f", F.coalesce("against", F.lit(0)).alias("against")), "crf-counts")
    share = n1 / (n1 + n0)
    out: set[str] = set()
    while True:
        n = F.col("n") + F.col("against")
        p = F.least(F.col("n") / n, F.lit(1 - 1e-9))
        ratio = F.col("n") * F.log(p / share) + F.col("against") * F.log((1 - p) / (1 - share))
        seen = bad.mapInPandas(counted(out), "f string, n bigint").groupBy("f").agg(F.sum("n").alias("n"))
        over = seen.join(may, "f").where(p > max(0.5, share)).select("f", ratio.alias("r")).where(F.col("r") > evidence)
        new = {r.f: r.r for r in over.collect() if r.f not in out}
        if not new:
            return out
        best = max(new.values())
        out |= {f for f, r in new.items() if r >= lead * best}


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABEL_ROWS, max_chars: int = TRAIN_CHARS,
        id_col: str = "doc_id", text_col: str = "text") -> bytes | None:
    """A trained field, pickled, from a bounded sample of the labelled rows outside the held-out fold.

    Tokens are labelled from counts over at most ``rows`` rows of each label;
    only the TRAIN_ROWS of each that the field is fitted on come to the
    driver.  Without a row of each label value there is nothing to learn: None.
    """
    sample = stored(train_rows(docs, labels, "toxic", rows, max_chars, id_col, text_col), "crf-sample")
    got = []
    for v in (0, 1):                                      # bounded: TRAIN_ROWS * 2 texts of max_chars characters
        got += sample.where(F.col("label") == v).orderBy("_id", "text").limit(TRAIN_ROWS).collect()
    toxic = np.array([r.label for r in got])
    if not len(got) or toxic.min() == toxic.max():
        return None
    marks = marks_of(sample.select("text", "label"))
    return pickle.dumps(train_field([r.text for r in got], toxic, marks))


@functools.lru_cache(maxsize=2)
def _field(model: bytes) -> Field:
    return pickle.loads(model)


def tag(field: Field, texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """(score, offending spans as (start, end) characters) of each text."""
    found = [[(m.start(), m.end()) for m in TOKEN.finditer(t)] for t in texts]
    lengths = np.array([len(f) for f in found], np.int64)
    emit = field.emissions([t[a:b].lower() for t, f in zip(texts, found) for a, b in f])
    p = marginals(emit, lengths, field.trans, field.begin)[0]
    at = np.cumsum(lengths) - lengths
    spans = []
    for f, lo, n in zip(found, at, lengths):
        hit = np.flatnonzero(p[lo:lo + n] >= SPAN)
        run: list[tuple[int, int]] = []
        for k in hit:                                     # neighbouring toxic tokens are one span
            if run and k and f[k - 1][1] == run[-1][1]:
                run[-1] = (run[-1][0], f[k][1])
            else:
                run.append(f[k])
        spans.append(run)
    return _scores(field, p, lengths), spans


def _scores(field: Field, p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    x = summaries(p, lengths)
    return 1 / (1 + np.exp(-(x @ field.scale[:3] + field.scale[3])))


def score_texts(field: Field, texts: list[str]) -> np.ndarray:
    """Scores alone, without offsets."""
    split = [_lower_words(t) for t in texts]
    lengths = np.array([len(s) for s in split], np.int64)
    emit = field.emissions([w for s in split for w in s])
    return _scores(field, marginals(emit, lengths, field.trans, field.begin)[0], lengths)


def score(text: Column, model: bytes | None) -> Column:
    """Toxicity of a text, 0 to 1; null and empty texts are scored as texts without tokens.

    Without a model nothing is known to be toxic: 0.
    """
    if model is None:
        return F.lit(0.0)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        field = _field(model)
        for s in batches:
            texts = [t if isinstance(t, str) else "" for t in s]
            parts = [score_texts(field, texts[p]) for p in blocks_of(list(map(len, texts)))]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return run(text)


def spans(docs: DataFrame, model: bytes | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, spans array of (start, end)): the offending character offsets of every row's whole text.

    Null and empty texts have no spans; repeated rows are tagged alike; an
    empty table gives no rows; other columns are not read.
    """
    prepare(docs.sparkSession)
    schema = "doc_id bigint, score double, spans array<struct<start:int,end:int>>"
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field = _field(model) if model is not None else None
        for b in batches:
            texts = [t if isinstance(t, str) else "" for t in b["text"]]
            for p in blocks_of(list(map(len, texts))):
                s, found = tag(field, texts[p]) if field else (np.zeros(p.stop - p.start), [[]] * (p.stop - p.start))
                yield pd.DataFrame({"doc_id": b["doc_id"].iloc[p].to_numpy(), "score": s,
                                    "spans": [[{"start": a, "end": z} for a, z in f] for f in found]})

    return rows.mapInPandas(run, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` by its whole text.

    Null, empty and blank texts are scored as texts without tokens; repeated
    rows are scored alike; a null id is never held out nor learned from; an
    empty table gives no rows; without labels of both values every score is
    0; other columns are not read.
    """
    prepare(docs.sparkSession)
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       score(F.col(text_col), model).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def not_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their columns, whatever their names.

    The model is fitted on ``labels``; without labels of both values every
    row stays, as do null, empty and blank texts that score below.  Repeated
    rows stay or go together; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    at, = fresh(docs, "__score")
    model = fit(docs, labels)
    return docs.withColumn(at, score(F.col("text"), model)).where(F.col(at) < threshold).select(*columns_of(docs))
