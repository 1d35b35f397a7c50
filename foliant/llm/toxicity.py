"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples are positives. Unlabelled texts are a sample of all rows that may be
learned from, whatever their labels say. A linear classifier is trained with numpy on
the corrected risk

    prior E_p[loss(f)] + max(0, E_u[loss(-f)] - prior E_p[loss(-f)])

where, whenever the second term of a batch falls below zero, the step goes against that
term instead. Features of a text are its hashed words and word beginnings of three to six
characters, each once; those stay that are clearly more common in the positives. The
sums are then calibrated on the same risk, so that the mean score of unlabelled texts
is the prior.

Training uses bounded samples, ``MAX_POSITIVE`` and ``MAX_UNLABELLED``, taken by a hash of the id
from rows whose crc32(doc_id) mod 3 is not 1; the prior is the share of confirmed rows
among all labelled ones with that remainder. Every document is scored, over its whole
text.

Defined results: NULL, empty and wordless texts get the score of a text without features; a
NULL doc_id has the remainder of the empty text and is not learned from; repeated rows get
equal results; repeated labels of a document count as toxic if one of them does; without
confirmed examples all scores are 0; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

SIZE = 1 << 18
MAX_POSITIVE, MAX_UNLABELLED = 3000, 6000
CUT = 0.7
MEMO = 1 << 19
WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[int]:
    """Hashed slots of a lower-cased word: itself and its beginnings."""
    parts = ["=" + word, *("^" + word[:n] for n in range(3, 7) if len(word) >= n)]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % SIZE for p in parts]


def text_words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def chosen_slots(positive: list[np.ndarray], unlabelled: list[np.ndarray], least: float = 6.0, lift: float = 2.0) -> np.ndarray:
    """Slots that more of the positives hold: by ``lift`` times and ``least`` standard errors."""
    n, m = len(positive), len(unlabelled)
    a, b = (np.bincount(np.concatenate(x), minlength=SIZE) if x else np.zeros(SIZE) for x in (positive, unlabelled))
    share = (a + b) / max(n + m, 1)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / max(n, 1) + 1 / max(m, 1)))
    return np.flatnonzero((a / max(n, 1) - b / max(m, 1) > least * error) & (a * m > lift * b * n))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, size: int = SIZE, epochs: int = 30, rate: float = 0.01, decay: float = 1e-5, seed: int = 7):
    """Weights of ``size`` slots and the intercept. Each text is an array of slots."""
    rng = np.random.default_rng(seed)
    theta, bias = np.zeros(size), -2.0
    m, v, mb, vb, step = np.zeros(size), np.zeros(size), 0.0, 0.0, 0
    if not positive or not unlabelled:
        return theta, bias

    def forward(texts):
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        slots = np.concatenate(texts).astype(np.int64)
        return slots, owner, np.bincount(owner, theta[slots], len(texts)) + bias

    batch = min(64, len(positive))
    rounds = max(1, -(-max(len(positive), len(unlabelled) // 4) // batch))
    each = max(1, len(unlabelled) // rounds)
    for _ in range(epochs):
        p_order = np.concatenate([rng.permutation(len(positive)) for _ in range(-(-rounds * batch // len(positive)))])
        u_order = np.resize(rng.permutation(len(unlabelled)), rounds * each)
        for r in range(rounds):
            p_slots, p_owner, p = forward([positive[i] for i in p_order[r * batch : (r + 1) * batch]])
            u_slots, u_owner, u = forward([unlabelled[i] for i in u_order[r * each : (r + 1) * each]])
            # Logistic loss: loss(f) has slope -sigmoid(-f), loss(-f) has slope sigmoid(f).
            rest = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
            gp, gu = -prior * _sigmoid(p) / len(p), _sigmoid(u) / len(u)
            if rest >= 0:
                gp = gp - prior * _sigmoid(-p) / len(p)
            else:
                gp, gu = -gp, -gu
            g = np.bincount(p_slots, gp[p_owner], size) + np.bincount(u_slots, gu[u_owner], size) + decay * theta
            gb = gp.sum() + gu.sum()
            step += 1
            m, mb = 0.9 * m + 0.1 * g, 0.9 * mb + 0.1 * gb
            v, vb = 0.999 * v + 0.001 * g * g, 0.999 * vb + 0.001 * gb * gb
            fix = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            theta -= rate * fix * m / (np.sqrt(v) + 1e-8)
            bias -= rate * fix * mb / (np.sqrt(vb) + 1e-8)
    return theta, bias


STEEPEST = 6.0


def calibrate(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and shift of the sums with the least corrected logistic risk, a convex problem.

    A slope above ``STEEPEST`` would make most scores equal; it is cut, and the shift found anew.
    """
    x = np.stack([unlabelled, np.ones(len(unlabelled))], 1)
    goal = prior * np.array([positive.mean(), 1.0])
    ridge = np.array([1e-4, 1e-8])
    risk = lambda w: np.logaddexp(0, x @ w).mean() - goal @ w + ridge @ (w * w)
    w = np.array([1.0, 0.0])
    for free in (slice(0, 2), slice(1, 2)):
        w[0] = min(max(w[0], 0.1), STEEPEST) if free.start else w[0]
        for _ in range(200):
            q = _sigmoid(x @ w)
            g = (x.T @ q / len(x) - goal + 2 * ridge * w)[free]
            h = ((x * (q * (1 - q))[:, None]).T @ x / len(x) + 2 * np.diag(ridge))[free, free]
            move = np.zeros(2)
            move[free] = np.linalg.solve(h, g)
            t = 1.0
            while t > 1e-9 and risk(w - t * move) > risk(w):
                t /= 2
            w = w - t * move
            if t <= 1e-9 or np.abs(t * move).max() < 1e-9:
                break
    return float(w[0]), float(w[1])


def held_out(doc_id="doc_id"):
    """Whether a row's labels are kept for the test."""
    digits = F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")
    return F.crc32(digits) % 3 == 1


def training_sample(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> DataFrame:
    """``doc_id``, ``positive`` and ``slots`` of the rows to learn from, no more than the two bounds.

    Slots are 32-bit numbers in one binary value, which keeps the collected sample small.
    """
    known = labels.where(~held_out() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    confirmed = known.where("toxic = 1").select("doc_id")
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = confirmed.orderBy(*by_hash).limit(max_positive).withColumn("positive", F.lit(True))
    anyone = docs.select("doc_id").where(~held_out() & F.col("doc_id").isNotNull()).distinct()
    anyone = anyone.orderBy(*by_hash).limit(max_unlabelled).withColumn("positive", F.lit(False))
    chosen = chosen.unionByName(anyone)
    # Bounded by the two parameters.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def slots(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: np.array(sorted({x for w in text_words(t) for x in word_features(w)}), np.int32).tobytes())

    told = rows.select("doc_id", "positive", F.pandas_udf(slots, "binary")("text").alias("slots"))
    # One text per id, so that repeated ids keep within the bounds.
    return told.groupBy("doc_id", "positive").agg(F.first("slots").alias("slots"))


def class_prior(labels: DataFrame) -> float:
    """The share of confirmed rows among the labelled ones that may be learned from."""
    known = labels.where(~held_out() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return float(known.agg(F.avg((F.coalesce("toxic", F.lit(0)) == 1).cast("double"))).head()[0] or 0.0)


def fit(docs: DataFrame, labels: DataFrame, **bounds) -> tuple[dict[int, float], float] | None:
    """Weights by slot and the intercept of the calibrated classifier; None without examples."""
    rows = training_sample(docs, labels, **bounds).orderBy("doc_id", "positive").collect()
    positive, unlabelled = ([np.frombuffer(r["slots"], np.int32) for r in rows if r["positive"] == p] for p in (True, False))
    prior = class_prior(labels)
    if not positive or not unlabelled or not 0 < prior < 1:
        return None
    kept = chosen_slots(positive, unlabelled)
    number = np.full(SIZE, -1)
    number[kept] = np.arange(len(kept))
    positive, unlabelled = ([n[n >= 0] for n in (number[x] for x in texts)] for texts in (positive, unlabelled))
    theta, bias = train(positive, unlabelled, prior, max(1, len(kept)))
    sums = [np.array([bias + theta[x].sum() for x in texts]) for texts in (positive, unlabelled)]
    slope, shift = calibrate(*sums, prior)
    return {int(k): slope * float(t) for k, t in zip(kept, theta)}, slope * bias + shift


def scorer(weights: dict[int, float], bias: float):
    """A function from a text to its score."""
    import math

    class Memo(dict):
        def __missing__(self, word: str) -> tuple[int, ...]:
            if len(self) >= MEMO:
                self.clear()
            found = self[word] = tuple(x for x in word_features(word) if x in weights)
            return found

    memo = Memo()

    def score(text: str | None) -> float:
        held: set[int] = set()
        for found in map(memo.__getitem__, text_words(text)):
            if found:
                held.update(found)
        # An exact sum does not depend on the order.
        total = bias + math.fsum(weights[x] for x in held)
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, total))))

    return score


def toxicity(docs: DataFrame, labels: DataFrame, cut: float = CUT, **bounds) -> DataFrame:
    """Per document: doc_id, held_out, score and predicted."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **bounds))

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = scorer(*model.value) if model.value else lambda text: 0.0
        for texts in batches:
            yield pd.Series([score(t) for t in texts], dtype="float64")

    rows = docs.select("doc_id", held_out().alias("held_out"), F.pandas_udf(scores, "double")("text").alias("score"))
    return rows.select("*", (F.col("score") >= cut).cast("int").alias("predicted"))
