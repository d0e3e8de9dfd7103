"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its hashed character n-grams (3 to 6 characters with
boundary marks, and the whole word).  Its vector is the mean of their vectors,
a passage's vector the mean of its words', and a linear softmax over the two
classes scores the passage.  Vectors and softmax are trained jointly in numpy
(gradient descent with momentum, so that a rare n-gram moves little) on a bounded sample of labelled documents.  An unseen misspelling
shares most of its n-grams with the word it spells.

A document's logit pools its overlapping passages of ``WINDOW`` words: in
training by their softmax-weighted mean, in scoring by the highest.  So a few
words in a very long text count as they do in a short one.

The model is linear after averaging, so scoring needs one number per n-gram
(the difference of its two logits); it is broadcast (``2**BITS`` floats).
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import forget, slices

BITS = 17
DIM = 8
WINDOW = 10
STRIDE = 5
EPOCHS = 80
#: Gradient descent with momentum; step sizes of the vectors, the softmax and its bias.
RATES = (60.0, 0.003, 0.1)
MOMENTUM = 0.9
DECAY = 1e-5
FREQUENT = 200
SCALE = 5.0               # size of the softmax's first weights
SEED = 20
#: The training sample: at most this many documents of each class, none longer
#: than MAX_TRAIN_CHARS (longer ones are scored, not learnt from).
MAX_POSITIVE = 700
MAX_NEGATIVE = 3300
MAX_TRAIN_CHARS = 16_000
MAX_WORDS = 600_000
#: N-grams that a step of the training expands at once.
PART_GRAMS = 1 << 18
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def grams(word: str, bits: int = BITS) -> list[int]:
    """Buckets of a word's character n-grams and of the word itself."""
    w = f"<{word}>"
    mask = (1 << bits) - 1
    parts = {w[i:i + n] for n in (3, 4, 5, 6) for i in range(len(w) - n + 1)}
    return [zlib.crc32(p.encode()) & mask for p in sorted(parts)] + [zlib.crc32(f"={w}".encode()) & mask]


def words_of(text: str | None) -> list[str]:
    """Lower-cased white-space words, outer punctuation kept (``clean`` drops it)."""
    return (text or "").lower().split()


def clean(word: str) -> str:
    return EDGES.sub("", word) or word


@dataclass
class Model:
    """``weights``: logit difference of every n-gram bucket; ``bias``: that of an empty text."""
    weights: np.ndarray
    bias: float


def _passages(n: int) -> list[tuple[int, int]]:
    if n <= WINDOW:
        return [(0, n)]
    starts = [*range(0, n - WINDOW, STRIDE), n - WINDOW]
    return [(s, s + WINDOW) for s in starts]


def _parts(first: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of words with about ``PART_GRAMS`` n-grams each, so that no step expands all of them at once."""
    cuts = np.unique(np.searchsorted(first, np.arange(0, first[-1], PART_GRAMS))).tolist()
    return list(zip(cuts, [*cuts[1:], len(first) - 1]))


def _gathered(values: np.ndarray, flat: np.ndarray, first: np.ndarray, parts: list[tuple[int, int]]) -> np.ndarray:
    """Sum of its n-grams' values for every word."""
    return np.concatenate([np.add.reduceat(values[flat[first[a]:first[b]]], first[a:b] - first[a]) for a, b in parts])


def _spread(values: np.ndarray, flat: np.ndarray, sizes: np.ndarray, first: np.ndarray,
            parts: list[tuple[int, int]], buckets: int) -> np.ndarray:
    """Sum of its words' values for every n-gram bucket."""
    out = np.zeros(buckets)
    for a, b in parts:
        np.add.at(out, flat[first[a]:first[b]], np.repeat(values[a:b].astype(np.float64), sizes[a:b]))
    return out


def train(texts: Iterable[str], labels: list[int], bits: int = BITS, dim: int = DIM,
          epochs: int = EPOCHS) -> Model:
    """Fit n-gram vectors and the softmax together; without both classes, a constant model.

    ``texts`` are read once, in the order of ``labels``.
    """
    rng = np.random.default_rng(SEED)
    y = np.asarray(labels, dtype=np.float64)
    if len(y) == 0 or y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        return Model(np.zeros(1 << bits, np.float32), float(np.log(rate / (1 - rate))))
    vocab: dict[str, int] = {}
    tokens, lo, hi, owner = array("I"), array("q"), array("q"), array("I")  # compact: some millions of tokens and n-grams
    for doc, text in enumerate(texts):
        at = len(tokens)
        tokens.extend([vocab.setdefault(clean(w), len(vocab)) for w in words_of(text)])
        for a, b in _passages(len(tokens) - at):
            if b > a:
                lo.append(at + a)
                hi.append(at + b)
                owner.append(doc)
    bags, sizes = array("I"), array("I")
    for w in vocab:
        own = grams(w, bits)
        bags.extend(own)
        sizes.append(len(own))
    del vocab
    flat, tokens, owner = (np.frombuffer(c, np.uint32) for c in (bags, tokens, owner))
    lo, hi = (np.frombuffer(c, np.int64) for c in (lo, hi))
    sizes = np.frombuffer(sizes, np.uint32).astype(np.intp)
    first = np.concatenate([[0], np.cumsum(sizes)])          # of each word's n-grams, and the end
    parts = _parts(first)
    width = (hi - lo).astype(np.float64)
    heads = np.flatnonzero(np.append(True, np.diff(owner) != 0))
    spread = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(owner))))
    target = y[owner[heads]]
    emb = rng.normal(0, 0.01, (1 << bits, dim))
    out = rng.choice([-1.0, 1.0], (dim, 1)) * np.array([[-SCALE, SCALE]])
    bias = np.array([0.0, np.log(target.mean() / (1 - target.mean()))])
    # frequent n-grams take smaller steps: their gradients are sums over many words
    often = _spread(np.bincount(tokens, minlength=len(sizes)), flat, sizes, first, parts, 1 << bits)
    damp = 1 / np.sqrt(np.maximum(1.0, often / FREQUENT))
    params = [emb, out, bias]
    speed = [np.zeros_like(p) for p in params]
    # With two classes the passages' logit gaps, and all gradients, pass through
    # one number for each n-gram and word: its vector along the softmax's direction.
    for _ in range(epochs):
        along = out[:, 1] - out[:, 0]
        word = _gathered(emb @ along, flat, first, parts) / sizes
        run = np.concatenate([[0.0], np.cumsum(word[tokens])])
        gap = (run[hi] - run[lo]) / width + bias[1] - bias[0]
        share = np.exp(gap - np.maximum.reduceat(gap, heads)[spread])
        share /= np.add.reduceat(share, heads)[spread]
        pooled = np.add.reduceat(share * gap, heads)
        err = 1 / (1 + np.exp(-np.clip(pooled, -30, 30))) - target
        d_gap = err[spread] * share / len(heads)
        edge = np.bincount(lo, d_gap / width, len(tokens) + 1) - np.bincount(hi, d_gap / width, len(tokens) + 1)
        d_word = np.bincount(tokens, np.cumsum(edge[:-1]), len(sizes)) / sizes
        d_emb = _spread(d_word, flat, sizes, first, parts, 1 << bits)
        d_out = emb.T @ d_emb
        grads = [np.outer(d_emb * damp, along), np.stack([-d_out, d_out], axis=1), np.array([-1.0, 1.0]) * d_gap.sum()]
        for p, v, g, rate in zip(params, speed, grads, RATES):
            v *= MOMENTUM
            v -= rate * (g + DECAY * p)
            p += v
    weights = np.where(often > 0, emb @ (out[:, 1] - out[:, 0]), 0)  # n-grams never seen weigh nothing
    return Model(weights.astype(np.float32), float(bias[1] - bias[0]))


class Scorer:
    """Scores texts with a model; the numbers of words seen are kept, up to a bound."""

    def __init__(self, model: Model):
        self.weights = model.weights.astype(np.float64).tolist()
        self.bias = model.bias
        self.bits = (len(self.weights) - 1).bit_length()
        self.known: dict[str, float] = {}

    def word(self, word: str) -> float:
        ids = grams(clean(word), self.bits)
        value = sum([self.weights[i] for i in ids]) / len(ids)
        if len(self.known) >= MAX_WORDS:
            self.known.clear()
        self.known[word] = value
        return value

    def logit(self, text: str | None) -> float:
        words = words_of(text)
        if not words:
            return self.bias
        values = [self.word(w) if v is None else v for w, v in zip(words, map(self.known.get, words))]
        n = len(values)
        if n <= WINDOW:
            return sum(values) / n + self.bias
        run = np.concatenate([[0.0], np.cumsum(values)])
        starts = np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW)
        return float((run[starts + WINDOW] - run[starts]).max()) / WINDOW + self.bias


def _score(sent):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        scorer = Scorer(sent.value)
        for part in slices(batches):
            logits = np.array([scorer.logit(t) for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(1 / (1 + np.exp(-np.clip(logits, -30, 30))), pa.float64())],
                names=[*part.schema.names, "score"])
    return score


def held_out(id_col: str):
    """True for the fifth of the ids that training never sees: crc32(id as text) mod 5 = 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE,
        max_negative: int = MAX_NEGATIVE, max_chars: int = MAX_TRAIN_CHARS) -> Model:
    """Train on at most ``max_positive + max_negative`` labelled documents outside the held-out fold.

    The sample is drawn by a hash of the id, so that it does not depend on the
    order of rows.  An id labelled both ways, or without a text, is left out.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("doc_id"))
             .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most"))
             .where(F.col("toxic") == F.col("_most")).select("doc_id", "toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = (known.where("toxic = 1").orderBy(*order).limit(max_positive)
              .unionByName(known.where("toxic = 0").orderBy(*order).limit(max_negative)))
    rows = (docs.select("doc_id", "text").where(F.length("text") <= max_chars)
            .join(F.broadcast(picked), "doc_id")  # at most max_positive + max_negative rows
            .groupBy("doc_id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))
            .orderBy(F.desc("doc_id")).collect())
    labels = [r.toxic for r in reversed(rows)]
    # by ascending id; a text is let go once it is read
    return train((rows.pop().text for _ in labels), labels)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with its columns, each row with ``score`` (0 to 1), ``predicted`` and ``held_out``.

    Every row is scored over its whole text; null and empty texts get the
    model's bias.  Existing columns of these names are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("score", "predicted", "held_out")
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes) + ", score double"
    return (docs.mapInArrow(_score(sent), schema)
            .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
            .withColumn("held_out", held_out("doc_id")))
