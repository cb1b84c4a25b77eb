"""Toxicity by a subsequence string kernel and a linear support vector machine on Nyström landmarks.

Strings are words in lower case. The kernel compares their subsequences of three characters, each weighted by a decay for
every character it skips (up to two), so an insult with inserted characters or gaps still shares most of them. Runs of single
letters set apart ("i d i o t") count as one more word.

Training is multiple-instance, from document labels: a toxic text needs one toxic word, a clean one has none. Landmarks are
words, the most telling ones of toxic texts and an even sample of clean ones; the Nyström map takes a word to its
kernel values with them, whitened. The machine is trained on words of clean texts against words that only toxic texts have,
then again against the best word of each toxic text. A word's decision is a sum over its subsequences, as the landmarks'
weights add up per subsequence; a text's score is that of its worst word, over the whole text.

The model is fitted in the driver on at most ``MAX_TOXIC`` and ``MAX_CLEAN`` labelled texts of the training part, chosen by
a hash, and ``MAX_WORDS`` of their words on either side. Everything else runs per row.

Defined results: NULL and empty texts have the score of a text without words; texts that occur in ``labels`` more than once
or with a NULL label take the highest label or none; without any toxic training text every score is 0.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bounds of what is fitted on.
MAX_TOXIC, MAX_CLEAN, MAX_WORDS = 2000, 6000, 6000
LANDMARKS = 256
DECAY = 0.6
#: Characters per string; longer words are cut into overlapping strings of this length.
WIDTH = 24
OVERLAP = 8
#: Characters are counted in this many classes; lower-case letters have their own.
ALPHABET = 64
THRESHOLD = 0.3
#: Weight of the squared norm against the mean loss of either side.
REGULAR = 1e-2
#: Places of the second and third character after the first, at most two characters skipped.
OFFSETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))

_WORD = re.compile(r"[^\s.,;:!?\"()\[\]{}|<>#$%&*_=+/\\~^`-]+(?:[.*_$#@!1-9'-]+[^\W\d_]+)*")
_SPELLED = re.compile(r"(?<!\w)(?:[^\W\d_][ .*_-]){2,}[^\W\d_](?!\w)")


def strings(text: str | None) -> set[str]:
    """The distinct strings of a text that are scored."""
    low = (text or "").lower()
    found = set(_WORD.findall(low))
    found |= {re.sub(r"[ .*_-]", "", m) for m in _SPELLED.findall(low)}
    out = set()
    for w in found:
        if len(w) <= WIDTH:
            out.add(w)
        else:
            out.update(w[i : i + WIDTH] for i in range(0, len(w) - OVERLAP, WIDTH - OVERLAP))
    return out


def _codes(words: list[str]) -> np.ndarray:
    """Character classes, a row per word between two marks for its ends, 0 where there is none."""
    table = np.zeros((len(words), WIDTH + 2), np.int64)
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    cls = np.where((flat >= 97) & (flat < 123), flat - 95, 28 + flat % (ALPHABET - 28))
    n = np.array([len(w) for w in words], np.int64)
    row = np.repeat(np.arange(len(words)), n)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
    table[row, col + 1] = cls
    table[:, 0] = 1
    table[np.arange(len(words)), n + 1] = 1
    return table


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the subsequences of each word, and their weights; weight 0 where there is none."""
    c = np.pad(_codes(words), ((0, 0), (0, 4)))
    n = WIDTH + 2
    numbers, weights = [], []
    for i, j in OFFSETS:
        a, b, d = c[:, :n], c[:, i : i + n], c[:, j : j + n]
        numbers.append((a * ALPHABET + b) * ALPHABET + d)
        weights.append(np.where((a > 0) & (b > 0) & (d > 0), DECAY ** (j - 2), 0.0))
    return np.concatenate(numbers, 1), np.concatenate(weights, 1)


def _norms(numbers: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Square roots of the kernel of each word with itself: equal subsequences of a word add up."""
    order = np.argsort(numbers, axis=1, kind="stable")
    f, w = np.take_along_axis(numbers, order, 1), np.take_along_axis(weights, order, 1)
    total = np.cumsum(w, axis=1)
    last = np.ones(f.shape, bool)
    last[:, :-1] = f[:, 1:] != f[:, :-1]
    ends = np.where(last, total, 0.0)
    before = np.maximum.accumulate(np.concatenate([np.zeros((len(f), 1)), ends[:, :-1]], 1), axis=1)
    runs = np.where(last, total - before, 0.0)
    return np.sqrt(np.maximum((runs * runs).sum(1), 1e-12))


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel values of words with landmarks."""
    fl, wl = _features(landmarks)
    norm = _norms(fl, wl)
    # rows only for the subsequences that landmarks have; row 0 for all others
    used = np.unique(fl[wl > 0])
    place = np.zeros(ALPHABET**3, np.int32)
    place[used] = np.arange(1, len(used) + 1)
    table = np.zeros((len(used) + 1, len(landmarks)), np.float32)
    np.add.at(table, (place[fl].ravel(), np.repeat(np.arange(len(landmarks)), fl.shape[1])), (wl / norm[:, None]).ravel())
    out = np.zeros((len(words), len(landmarks)))
    for i in range(0, len(words), 512):
        f, w = _features(words[i : i + 512])
        norm = _norms(f, w)
        for k in range(f.shape[1]):
            on = np.nonzero((w[:, k] > 0) & (place[f[:, k]] > 0))[0]
            if len(on):
                out[i + on] += table[place[f[on, k]]] * w[on, k, None]
        out[i : i + 512] /= norm[:, None]
    return out


@dataclass
class Model:
    """Weights per subsequence, and the map from a decision to a score."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def decisions(self, words: list[str]) -> np.ndarray:
        f, w = _features(words)
        return (self.weights[f] * w).sum(1) / _norms(f, w) + self.bias

    def score(self, worst: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (worst - self.shift) + np.log(THRESHOLD / (1 - THRESHOLD)), -60, 60)))


#: Decisions a task remembers before it starts afresh; bounds memory, never changes results.
MAX_KNOWN = 250_000
#: The decision for a text without words.
NO_WORDS = -10.0


def _train_linear(x: np.ndarray, y: np.ndarray, balance: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Linear machine with squared hinge loss, by accelerated descent over all rows; the last weight is the bias."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    reg = np.full(x.shape[1], REGULAR)
    reg[-1] = 1e-6
    v = z = np.zeros(x.shape[1])
    rate = 1.0 / (2 * np.linalg.norm(x * np.sqrt(balance)[:, None], 2) ** 2 + reg.max())
    for t in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ z))
        new = z - rate * (reg * z - 2 * x.T @ (balance * y * slack))
        z, v = new + t / (t + 3) * (new - v), new
    return v


def fit(toxic: list[set[str]], clean_counts: dict[str, int], n_clean: int, seed: int = 7) -> Model | None:
    """The model from the words of each toxic text, and the numbers of clean texts by word."""
    toxic = [t for t in toxic if t]
    if not toxic:
        return None
    rng = np.random.default_rng(seed)
    counts: dict[str, int] = {}
    for t in toxic:
        for w in t:
            counts[w] = counts.get(w, 0) + 1
    rate = lambda w: (counts[w] + 0.1) / (len(toxic) + 1) / ((clean_counts.get(w, 0) + 0.1) / (n_clean + 1))
    only = sorted((w for w in counts if rate(w) > 3), key=lambda w: (-counts[w] * np.log(rate(w)), w))[:MAX_WORDS]
    only = [w for w in only if len(w) > 2] or only
    clean = sorted(clean_counts, key=lambda w: (-clean_counts[w], w))
    if len(clean) > MAX_WORDS:
        clean = clean[: MAX_WORDS // 4] + [clean[MAX_WORDS // 4 + i] for i in np.sort(rng.choice(len(clean) - MAX_WORDS // 4, MAX_WORDS - MAX_WORDS // 4, replace=False))]
    if not only or not clean:
        return None
    half = LANDMARKS // 2
    picks = clean if len(clean) <= half else [clean[i] for i in rng.choice(len(clean), half, replace=False)]
    landmarks = list(dict.fromkeys(only[:half] + picks))
    # whitening of the landmarks' own kernel
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks) + 1e-6 * np.eye(len(landmarks)))
    white = vectors[:, values > 1e-4] / np.sqrt(values[values > 1e-4])
    xc = kernel(clean, landmarks) @ white
    xo = kernel(only, landmarks) @ white
    row = {w: i for i, w in enumerate(only)}
    member = [[row[w] for w in sorted(t) if w in row] for t in toxic]
    member = [m for m in member if m]
    weight = np.array([counts[w] for w in only], float)
    for _ in range(4):
        on = weight > 0
        x, y = np.concatenate([xc, xo[on]]), np.concatenate([-np.ones(len(xc)), np.ones(int(on.sum()))])
        each = np.concatenate([np.full(len(xc), 1.0 / len(xc)), weight[on] / weight.sum()])
        v = _train_linear(x, y, each)
        decision = xo @ v[:-1]
        # each toxic text votes for its worst word; the next machine separates those
        weight = np.zeros(len(only))
        for m in member:
            weight[m[int(np.argmax(decision[m]))]] += 1
    beta = white @ v[:-1]
    fl, wl = _features(landmarks)
    table = np.zeros(ALPHABET**3)
    np.add.at(table, fl.ravel(), (wl * (beta / _norms(fl, wl))[:, None]).ravel())
    model = Model(table, float(v[-1]), 1.0, 0.0)
    # the score is THRESHOLD where most texts are told apart: between the worst clean words and the worst words of toxic texts
    toxic_worst = np.sort([float(model.decisions(sorted(t)).max()) for t in toxic])
    names = list(clean_counts)
    clean_worst = np.concatenate([model.decisions(names[i : i + 4096]) for i in range(0, len(names), 4096)])
    share = np.array([clean_counts[w] for w in names], float) / max(1, n_clean)
    cuts = np.unique(np.concatenate([toxic_worst, toxic_worst - 1e-9]))
    order = np.argsort(-clean_worst)
    upto = np.concatenate([[0.0], np.cumsum(share[order])])
    false = np.minimum(1.0, upto[np.searchsorted(-clean_worst[order], -cuts, side="right")]) * n_clean
    found = len(toxic_worst) - np.searchsorted(toxic_worst, cuts)
    f1 = 2 * found / (found + false + len(toxic_worst))
    at = cuts[int(np.argmax(f1))]
    below = clean_worst[clean_worst < at]
    gap = max(at - (below.max() if len(below) else at - 1), 1e-3)
    model.shift = float(at - gap / 2)
    model.slope = float(4.0 / max(np.median(toxic_worst) - model.shift, 0.1))
    return model


def training_part(doc_id: Column) -> Column:
    """Labels may be learnt from these documents; the others are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on a bounded sample of the labelled texts of the training part."""
    known = labels.where(F.col("doc_id").isNotNull() & training_part(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic is not null")
    # the smallest hashes of either label
    key = F.xxhash64("doc_id", F.lit("toxicity"))
    chosen = known.where("toxic = 1").orderBy(key, "doc_id").limit(MAX_TOXIC).unionByName(
        known.where("toxic = 0").orderBy(key, "doc_id").limit(MAX_CLEAN)
    ).withColumnRenamed("doc_id", "l_id")

    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(strings(t)) for t in texts], dtype=object)

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id"))
    rows = rows.select("toxic", split("text").alias("words"))
    clean = rows.where("toxic = 0")
    counts = clean.select(F.explode("words").alias("w")).groupBy("w").count()
    # a word is one string however many texts have it
    toxic = [{sys.intern(w) for w in r[0]} for r in rows.where("toxic = 1").select("words").toLocalIterator()]
    found = counts.toArrow()
    clean_counts = dict(zip(map(sys.intern, found.column("w").to_pylist()), found.column("count").to_pylist()))
    del found
    return fit(toxic, clean_counts, clean.count())


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, float] = {}
        for texts in batches:
            out = np.full(len(texts), NO_WORDS)
            for i in range(0, len(texts) if model else 0, 512):
                sets = [strings(t) for t in texts.iloc[i : i + 512]]
                if len(known) > MAX_KNOWN:
                    known.clear()
                new = list(set().union(*sets).difference(known))
                for k in range(0, len(new), 2048):
                    known.update(zip(new[k : k + 2048], model.decisions(new[k : k + 2048]).tolist()))
                out[i : i + len(sets)] = [max(map(known.__getitem__, s), default=NO_WORDS) for s in sets]
            yield pd.Series(np.zeros(len(texts)) if model is None else model.score(out))

    found = docs.select("doc_id", (~training_part(F.col("doc_id"))).alias("held_out"), rate(F.col("text")).alias("score"))
    return found.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
