"""Toxic spans and scores by a linear-chain conditional random field.

Only documents are labelled, so tokens get their labels from them: a token is offending if it
stands in a toxic document and its word, or a beginning of it, is found almost only in those. The
field has two tags, features of the word and of its beginnings, and learns weights and tag
transitions from these token labels. Forward-backward gives each token's marginal probability of
being offending; a document's marginals are aggregated (the largest's log odds, sum, share) and a logistic curve,
fitted on labelled documents that the field wasn't trained on, turns them into the score.
Neighbouring tokens with a marginal of a half or more are the offending spans.

The field is fitted on the driver, on a sample of at most ``TOXIC_ROWS`` toxic and ``OTHER_ROWS``
other labelled documents of at most ``SAMPLE_CHARS`` characters each, chosen by a hash of doc_id.
At most ``MODEL_FEATURES`` features, the strongest, make up the model. Every text is scored whole
and as one chain; one of over ``STRETCH`` tokens is read in stretches that hand on their messages.
Defined results: null is the empty text, which has a score like any other; labels without doc_id
or with a null mark are not used; of repeated labels the larger counts; without labels of both
kinds every score is the share of toxic labels (0 if there is no label).
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from entigrid.llm.common import free_name, kept_by_worker

TOXIC_ROWS, OTHER_ROWS, SAMPLE_CHARS = 1500, 2500, 20_000
STRETCH = 2048
REJECT = 0.3
MODEL_FEATURES = 200_000

_TOKEN = re.compile(r"\w+")
_BEGINNINGS = range(3, 8)
_MEMORY_WORDS = 100_000


class Model(NamedTuple):
    weights: dict[str, float]
    bias: float
    #: log potentials of tag 0 after 0, 1 after 0, 0 after 1, 1 after 1
    steps: tuple[float, float, float, float]
    #: of the logistic curve: constant, then one for each aggregate
    curve: tuple[float, ...]


def tokens(text: str | None) -> list[str]:
    """Lower-cased one by one: lower-casing a whole text can change how many tokens it has."""
    return [t.lower() for t in _TOKEN.findall(text or "")]


def features(word: str) -> list[str]:
    return ["=" + word, *(word[:n] for n in _BEGINNINGS if n < len(word))]


# The chain -------------------------------------------------------------------


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows as columns of one array, and which cells are theirs."""
    sizes = np.array([len(r) for r in rows])
    there = np.arange(sizes.max())[:, None] < sizes[None, :]
    out = np.zeros(there.shape)
    out.T[there.T] = np.concatenate(rows)
    return out, there


def _forward_backward(emission: np.ndarray, there: np.ndarray, steps: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of tag 1, and the expected numbers of the four tag steps over all columns."""
    e = np.exp(np.clip(emission, -30, 30))
    a, b, c, d = np.exp(np.clip(steps, -30, 30))
    length, width = e.shape
    ahead = np.empty((length, width))  # probability of tag 1, given the tokens up to here
    p = e[0] / (1 + e[0])
    ahead[0] = p
    for t in range(1, length):
        q = 1 - p
        one = (q * b + p * d) * e[t]
        now = one / (one + q * a + p * c)
        p = np.where(there[t], now, p)
        ahead[t] = p
    marginal = np.empty((length, width))
    counts = np.zeros(4)
    back = np.full(width, 0.5)  # share of tag 1 in what the tokens after here say
    marginal[-1] = ahead[-1]
    for t in range(length - 2, -1, -1):
        inside = there[t + 1]
        to_one, to_none = e[t + 1] * back, 1 - back
        p, q = ahead[t], 1 - ahead[t]
        w = np.array([q * a * to_none, q * b * to_one, p * c * to_none, p * d * to_one])
        w /= w.sum(axis=0)
        counts += (w * inside).sum(axis=1)
        marginal[t] = np.where(inside, w[2] + w[3], p)
        zero, one = a * to_none + b * to_one, c * to_none + d * to_one
        back = np.where(inside, one / (zero + one), 0.5)
    return marginal, counts


def _ahead(e: np.ndarray, there: np.ndarray, steps: np.ndarray, p: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The forward message at each token, its probability of tag 1 given the tokens up to it, from
    that of the token before the stretch (None at the beginning of the text)."""
    a, b, c, d = steps
    ahead = np.empty_like(e)
    for t in range(len(e)):
        if p is None:
            p = e[t] / (1 + e[t])
        else:
            one = (p * (d - b) + b) * e[t]
            p = np.where(there[t], one / (one + p * (c - a) + a), p)
        ahead[t] = p
    return ahead, p


def _behind(e: np.ndarray, there: np.ndarray, steps: np.ndarray, ahead: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of tag 1, and the backward message that goes to the stretch before."""
    a, b, c, d = steps
    marginal = np.empty_like(e)
    for t in range(len(e) - 1, -1, -1):
        p = ahead[t]
        own = p * back
        marginal[t] = own / (own + (1 - p) * (1 - back))
        to_one, to_none = e[t] * back, 1 - back
        zero, one = a * to_none + b * to_one, c * to_none + d * to_one
        back = np.where(there[t], one / (zero + one), back)
    return marginal, back


def marginals(rows: list[np.ndarray], steps: tuple) -> list[np.ndarray]:
    """For each row of emission scores, its tokens' probabilities of tag 1.

    Long rows are read in stretches, which hand their messages on, so a row is one chain."""
    e_steps = np.exp(np.clip(steps, -30, 30))
    out: list[np.ndarray] = [np.zeros(0)] * len(rows)
    order = sorted((i for i, r in enumerate(rows) if len(r)), key=lambda i: len(rows[i]))
    for s in range(0, len(order), 128):
        own = order[s : s + 128]
        cuts, p = [], None
        for at in range(0, len(rows[own[-1]]), STRETCH):
            emission, there = _padded([rows[i][at : at + STRETCH] for i in own])
            e = np.exp(np.clip(emission, -30, 30))
            ahead, p = _ahead(e, there, e_steps, p)
            cuts.append((e, there, ahead))
        back, found = np.full(len(own), 0.5), []
        while cuts:
            marginal, back = _behind(*cuts[-1][:2], e_steps, cuts[-1][2], back)
            found.append(marginal)
            cuts.pop()
        whole = np.concatenate(found[::-1])
        for k, i in enumerate(own):
            out[i] = whole[: len(rows[i]), k].copy()
    return out


def aggregates(m: np.ndarray) -> tuple[float, float, float]:
    """How sure the surest token is, and how many there are, in number and as a share."""
    if not len(m):
        return -2.0, 0.0, 0.0
    top, total = float(np.clip(m.max(), 3e-4, 1 - 3e-4)), float(m.sum())
    return float(np.log(top / (1 - top))) / 4, float(np.log1p(total)), float(np.sqrt(total / len(m)))


# Fitting ---------------------------------------------------------------------


def _token_labels(rows: list[list[str]], toxic: list[int]) -> tuple[list[np.ndarray], dict[str, int]]:
    """Token labels, and numbers of the features that at least three documents have."""
    inside, outside = Counter(), Counter()
    for row, y in zip(rows, toxic):
        (inside if y else outside).update(set(chain.from_iterable(features(w) for w in set(row))))
    kinds = max(sum(toxic), 1), max(len(toxic) - sum(toxic), 1)

    def telling(f: str) -> bool:
        return inside[f] >= 4 and inside[f] / kinds[0] >= 30 * (outside[f] + 0.5) / kinds[1]

    marks = {f for f in inside if telling(f)}
    number = {f: i for i, f in enumerate(sorted(f for f in inside.keys() | outside.keys() if inside[f] + outside[f] >= 3))}
    known: dict[str, bool] = {}
    labels = []
    for row, y in zip(rows, toxic):
        if not y:
            labels.append(np.zeros(len(row)))
            continue
        for w in set(row).difference(known):
            known[w] = not marks.isdisjoint(features(w))
        labels.append(np.array([known[w] for w in row], dtype=float))
    return labels, number


def _fit_chain(rows: list[list[str]], labels: list[np.ndarray], number: dict[str, int], passes: int = 6) -> tuple[np.ndarray, tuple]:
    """Weights (the last is the bias) and tag steps of the largest penalised likelihood, by AdaGrad."""
    words = {w: i for i, w in enumerate(sorted(set(chain.from_iterable(rows))))}
    own = [[number[f] for f in features(w) if f in number] + [len(number)] for w in words]
    flat, at = np.array(list(chain.from_iterable(own))), np.cumsum([0] + [len(o) for o in own])
    coded = [np.array([words[w] for w in row], dtype=np.int64) for row in rows]
    pieces = [(c[s : s + STRETCH], y[s : s + STRETCH]) for c, y in zip(coded, labels) for s in range(0, len(c), STRETCH)]
    pieces.sort(key=lambda p: len(p[0]))
    batches = [pieces[s : s + 64] for s in range(0, len(pieces), 64)]
    weights, squares = np.zeros(len(number) + 1), np.full(len(number) + 1, 1e-6)
    steps, step_squares = np.zeros(4), np.full(4, 1e-6)
    random = np.random.default_rng(7)
    sizes = np.diff(at)
    owner = np.repeat(np.arange(len(words)), sizes)
    for _ in range(passes):
        for b in random.permutation(len(batches)):
            batch = batches[b]
            score = np.add.reduceat(weights[flat], at[:-1]) if len(flat) else np.zeros(0)
            columns, there = _padded([score[c] for c, _ in batch])
            truth, _ = _padded([y for _, y in batch])
            m, expected = _forward_backward(columns, there, tuple(steps))
            gap = (truth - m).T[there.T]
            by_word = np.bincount(np.concatenate([c for c, _ in batch]), gap, len(words))
            slope = np.bincount(flat, by_word[owner], len(weights)) - 1e-3 * weights
            squares += slope**2
            weights += 0.5 * slope / np.sqrt(squares)
            before, after, both = truth[:-1], truth[1:], there[1:]
            seen = [((1 - before) * (1 - after))[both].sum(), ((1 - before) * after)[both].sum(), (before * (1 - after))[both].sum(), (before * after)[both].sum()]
            slope = np.array(seen) - expected - 1e-2 * steps
            step_squares += slope**2
            steps += 0.2 * slope / np.sqrt(step_squares)
    return weights, tuple(float(s) for s in steps)


def _fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Penalised logistic regression of weighted rows by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [0.05] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - penalty @ w
        w = w + np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)), slope)
    return tuple(float(v) for v in w)


def fit(texts: list[str | None], toxic: list[int], apart: list[bool], rate: float | None = None) -> Model:
    """A model from labelled texts; those set apart only fit the curve. ``rate`` is the share of
    toxic documents among all, if the sample's is another."""
    share = sum(toxic) / len(toxic) if toxic else 0.0
    rate = share if rate is None else rate
    first = [i for i, a in enumerate(apart) if not a]
    second = [i for i, a in enumerate(apart) if a]
    both = lambda own: len({toxic[i] for i in own}) == 2
    if not both(first) or not both(second):
        first = second = list(range(len(texts)))
    if not both(first):
        constant = float(np.log((rate + 1e-6) / (1 - rate + 1e-6)))
        return Model({}, 0.0, (0.0,) * 4, (constant, 0.0, 0.0, 0.0))
    rows = [tokens(t) for t in texts]
    labels, number = _token_labels([rows[i] for i in first], [toxic[i] for i in first])
    weights, steps = _fit_chain([rows[i] for i in first], labels, number)
    strong = sorted(((abs(weights[i]), f) for f, i in number.items() if abs(weights[i]) > 1e-3), reverse=True)[:MODEL_FEATURES]
    model = Model({f: float(weights[number[f]]) for _, f in strong}, float(weights[-1]), steps, (0.0,) * 4)
    scorer = Scorer(model)
    x = np.array([aggregates(m) for m in scorer.marginals([rows[i] for i in second])])
    y = np.array([toxic[i] for i in second], dtype=float)
    weight = np.where(y == 1, rate / share, (1 - rate) / (1 - share))
    return model._replace(curve=_fit_curve(x, y, weight))


# Scoring ---------------------------------------------------------------------


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self._scores: dict[str, float] = {}

    def _score(self, word: str) -> float:
        weight = self.model.weights.get
        return self.model.bias + sum(weight(f, 0.0) for f in features(word))

    def marginals(self, rows: list[list[str]]) -> list[np.ndarray]:
        scores = self._scores
        if len(scores) > _MEMORY_WORDS:
            scores.clear()
        for row in rows:
            for w in set(row).difference(scores):
                scores[w] = self._score(w)
        return marginals([np.fromiter(map(scores.__getitem__, row), float, len(row)) for row in rows], self.model.steps)

    def read(self, texts: list[str | None]) -> list[tuple[float, list[tuple[int, int]]]]:
        """Score and offending spans (code points, ends exclusive) of each text."""
        out = []
        constant, *slopes = self.model.curve
        for text, m in zip(texts, self.marginals([tokens(t) for t in texts])):
            z = constant + sum(a * b for a, b in zip(slopes, aggregates(m)))
            spans: list[tuple[int, int]] = []
            if len(m) and m.max() >= 0.5:
                last = -2
                places = [t.span() for t in _TOKEN.finditer(text)]  # the tokens' own, in the text as it is
                for i in np.flatnonzero(m >= 0.5).tolist():
                    spans[-1:] = [(spans[-1][0], places[i][1])] if i == last + 1 else [*spans[-1:], places[i]]
                    last = i
            out.append((float(1 / (1 + np.exp(-np.clip(z, -60, 60)))), spans))
        return out


def _scorer(held: Broadcast) -> Scorer:
    model = held.value
    return kept_by_worker("toxicity", id(model), lambda: Scorer(model))


def held_out(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2


def usable_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the labels that may be learnt from, one for each document."""
    own = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out())
    return own.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic): the bounded sample of labelled documents."""
    usable = usable_labels(labels)
    by_hash = lambda y, n: usable.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = by_hash(1, TOXIC_ROWS).union(by_hash(0, OTHER_ROWS))  # at most that many rows, so broadcast
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(F.length("text") <= SAMPLE_CHARS)
    return own.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    apart = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 3
    rows = training_rows(docs, labels).select("doc_id", "text", "toxic", apart.alias("apart")).collect()
    rows.sort(key=lambda r: r.doc_id)
    rate = usable_labels(labels).agg(F.avg("toxic")).first()[0]
    return fit([r.text for r in rows], [r.toxic for r in rows], [r.apart for r in rows], rate)


def with_scores(docs: DataFrame, model: Model, into: str) -> DataFrame:
    """The documents with a struct column ``into``: score, and spans (start, end, start, ...)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, spans array<int>")
    def score(texts: pd.Series) -> pd.DataFrame:
        found = _scorer(held).read(texts.tolist())
        return pd.DataFrame({"score": [s for s, _ in found], "spans": [[x for span in spans for x in span] for _, spans in found]})

    return docs.withColumn(into, score(F.col("text")))


def accepted(docs: DataFrame, model: Model, reject: float = REJECT) -> DataFrame:
    """The documents with a score below ``reject``, same columns."""
    into = free_name(docs, "toxicity")
    return with_scores(docs, model, into).filter(F.col(f"`{into}`.score") < reject).drop(into)
