"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Every token has a fixed sparse random index vector. A token's word vector is the sum of
the index vectors that stand near it anywhere in the corpus, so tokens used alike have
like vectors. Tokens are numbered by a hash into a fixed count of buckets, which bounds
the table of vectors at any corpus size.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalframe.llm.learning import Adam, chosen, held_out, log_loss, sample, sigmoid, temperature
from tidalframe.llm.store import written
from tidalframe.llm.words import Numbers, Store, expand, slices, split_words, sums

BUCKETS, DIM = 1 << 14, 32
# Non-zero places of an index vector, and how far apart tokens count as neighbours.
PLACES, REACH = 2, 2
# Labelled rows the network is fitted on, at most.
FITTED = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 256, 0.003, 1e-4
LIMIT = 0.3

# A word is read as its parts: letters, digits, and runs of other marks.
PART = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
VECTOR = 2 * DIM + 3


def letters(part: str) -> int:
    return zlib.crc32((part.lower() if len(part) > 1 and part[1:].islower() else part).encode()) % BUCKETS


MARKS = {mark: zlib.crc32(mark.encode()) % BUCKETS for mark in ".,;:!?"}


def parts_of(word: str) -> list[int]:
    """Buckets of a word's parts: letters as written, numbers by length, marks up to three alike."""
    # Most words are letters alone or before one mark.
    if word.isalpha():
        return [letters(word)]
    if word[-1:] in MARKS and word[:-1].isalpha():
        return [letters(word[:-1]), MARKS[word[-1]]]
    out = []
    for part in PART.findall(word):
        if part.isdigit():
            part = f"0{len(part)}"
        elif not part[0].isalnum():
            part = part[:3]
        else:
            out.append(letters(part))
            continue
        out.append(zlib.crc32(part.encode()) % BUCKETS)
    return out


class Parts:
    """Buckets of words' parts; a worker remembers the words that it has taken apart, about so many."""

    def __init__(self, remembered: int = 300_000):
        self.remembered, self.numbers, self.held = remembered, Numbers(), Store()

    def take(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(buckets of different words one after another, how many each has)."""
        if len(self.numbers) > self.remembered:
            self.numbers, self.held = Numbers(), Store()
        listed = words.to_pylist()
        numbers = np.fromiter(map(self.numbers.__getitem__, listed), np.int64, len(listed))
        if self.numbers.fresh:
            found = [parts_of(w) for w in self.numbers.fresh]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self.held.add(np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes)
            self.numbers.fresh.clear()
        return self.held.take(numbers)


known_parts = lru_cache(maxsize=1)(Parts)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all texts' tokens, tokens of each text).

    Texts are split at plain white space; a part never holds any, so other white space
    inside a word only parts it as it would anywhere.
    """
    index, counts, different = split_words(texts)
    flat, sizes = known_parts().take(different)
    lens = sizes[index]
    out = flat[expand((np.cumsum(sizes) - sizes)[index], lens)].astype(np.int64)
    return out, sums(lens, counts)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of the index vector of each bucket, always the same."""
    rng = np.random.Generator(np.random.Philox(7))
    return rng.integers(0, DIM, (BUCKETS, PLACES)), rng.choice([-1, 1], (BUCKETS, PLACES)).astype(np.int8)


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The word vectors of all buckets, from every document: BUCKETS by DIM, unit length, mean taken off.

    A task adds its texts up in a table of that fixed size; Spark adds the tables.
    """
    names = [f"v{k}" for k in range(DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS * DIM, np.int64)
        place, sign = index_vectors()
        # One number names an index vector's entry: its place, and whether it is negative.
        entry = place * 2 + (sign < 0)
        signed = np.zeros(BUCKETS * DIM * 2, np.int64)
        for batch in slices(batches, "text"):
            flat, lens = tokens(batch.column(0))
            doc = np.repeat(np.arange(len(lens)), lens)
            for far in range(1, REACH + 1):
                near = doc[far:] == doc[:-far]
                a, b = flat[:-far][near], flat[far:][near]
                for x, y in ((a, b), (b, a)):
                    for k in range(PLACES):
                        signed += np.bincount(x * (2 * DIM) + entry[y, k], minlength=len(signed))
        pairs = signed.reshape(-1, 2)
        total = (pairs[:, 0] - pairs[:, 1]).reshape(BUCKETS, DIM)
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(total[used, k]) for k in range(DIM)]], ["bucket", *names])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket long, " + ", ".join(f"{n} long" for n in names))
    summed = rows.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).toArrow()  # at most BUCKETS rows
    out, at = np.zeros((BUCKETS, DIM), np.float64), summed.column("bucket").to_numpy()
    for k, name in enumerate(names):
        out[at, k] = summed.column(name).to_numpy()
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    out = np.divide(out, norm, out=np.zeros_like(out), where=norm > 0)
    used = norm[:, 0] > 0
    if used.any():
        out[used] -= out[used].mean(axis=0)
    return out.astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Per text: mean and spread of its tokens' vectors, their count, and how many differ."""
    flat, lens = tokens(texts)
    out = np.zeros((len(texts), VECTOR), np.float32)
    some = np.flatnonzero(lens)
    if len(some):
        doc = np.repeat(np.arange(len(texts)), lens)
        key, times = np.unique(doc * BUCKETS + flat, return_counts=True)
        kinds = np.bincount(key // BUCKETS, minlength=len(texts))
        starts, n = (np.cumsum(kinds) - kinds)[some], lens[some, None]
        held, weight = vectors[key % BUCKETS], times[:, None].astype(np.float32)
        weighted = held * weight
        mean = np.add.reduceat(weighted, starts, axis=0) / n
        square = np.add.reduceat(np.multiply(weighted, held, out=weighted), starts, axis=0) / n
        out[some, :DIM], out[some, DIM : 2 * DIM] = mean, np.sqrt(np.maximum(square - mean * mean, 0))
        out[some, 2 * DIM] = np.log1p(lens[some])
        out[some, 2 * DIM + 1] = kinds[some] / lens[some]
        out[some, 2 * DIM + 2] = np.linalg.norm(mean, axis=1)
    return out


@dataclass
class Network:
    """Two layers over scaled inputs; the logit is divided by a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    heat: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        """Added up input by input, so that a row's logit does not depend on the rows beside it, as a product of matrices does."""
        w1, b1, w2, b2 = self.layers
        z, hidden = (x - self.mean) / self.scale, np.zeros((len(x), w1.shape[1]))
        for j, weights in enumerate(w1):
            hidden += z[:, j, None] * weights
        hidden, out = np.tanh(hidden + b1), np.zeros(len(x))
        for j, weight in enumerate(w2):
            out += hidden[:, j] * weight
        return out + b2[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logit(x) / self.heat)


def fit(x: np.ndarray, y: np.ndarray, seed: int = 11) -> Network:
    """A network by Adam on four fifths of the rows, its epoch and temperature chosen on the rest."""
    rng = np.random.default_rng(seed)
    if len(y) == 0:
        return Network(np.zeros(VECTOR), np.ones(VECTOR), [np.zeros((VECTOR, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.zeros(1)])
    x, y = x.astype(np.float64), y.astype(np.float64)
    order = rng.permutation(len(y))
    test, train = order[: len(y) // 5], order[len(y) // 5 :]
    net = Network(x[train].mean(axis=0), x[train].std(axis=0) + 1e-6, [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)])
    z = (x - net.mean) / net.scale
    adam, best = Adam(net.layers, RATE), (np.inf, None)
    for _ in range(EPOCHS):
        turn = rng.permutation(train)
        for at in range(0, len(turn), BATCH):
            rows = turn[at : at + BATCH]
            w1, b1, w2, b2 = net.layers
            h = np.tanh(z[rows] @ w1 + b1)
            d = (sigmoid(h @ w2 + b2[0]) - y[rows]) / len(rows)
            back = np.outer(d, w2) * (1 - h * h)
            adam.step([z[rows].T @ back + DECAY * w1, back.sum(axis=0), h.T @ d + DECAY * w2, np.array([d.sum()])])
        loss = log_loss(y[test], net.logit(x[test])) if len(test) else 0.0
        if loss < best[0]:
            best = (loss, [p.copy() for p in net.layers])
    net.layers = best[1] or net.layers
    net.heat = temperature(y[test], net.logit(x[test]))
    return net


def quality_scores(docs: DataFrame, labels: DataFrame, limit: float = LIMIT, fitted: int = FITTED, id_col: str = "doc_id", text_col: str = "text", carried: tuple[str, ...] = ()) -> DataFrame:
    """Scores every whole text: doc_id, held_out, score (near 1: good), predicted, _c_<carried>.

    Word vectors come from all documents, labels only from those not held out, at most
    ``fitted`` of them. A null or empty text has the zero vector and the score the
    network gives it; without any label the score is 0.5; repeated rows score alike; a
    null id is never held out nor learnt from; an empty table gives no rows.
    """
    spark = docs.sparkSession
    vectors = spark.sparkContext.broadcast(word_vectors(docs, text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"_c_{c}") for c in carried if c != text_col])
    kept = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    names = rows.columns[1:]

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = pooled(batch.column(1), vectors.value)
            held = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), VECTOR).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), held], ["doc_id", "vector"])

    known = written(chosen(labels, "quality", fitted), "labels")
    texts = rows.select("doc_id", "text").join(F.broadcast(known.select("label_id")), F.col("doc_id") == F.col("label_id"), "left_semi")
    learnt = sample(texts.mapInArrow(pool, "doc_id long, vector array<float>"), known, "vector").orderBy("doc_id").select("vector", "label").toArrow()
    net = fit(learnt.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, VECTOR), learnt.column("label").to_numpy())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = pooled(batch.column(1), vectors.value).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(net.score(x)), *batch.columns[1:]], ["doc_id", "score", *names])

    scored = rows.mapInArrow(score, f"doc_id long, score double{kept}")
    carry = [F.col("text" if c == text_col else f"_c_{c}").alias(f"_c_{c}") for c in carried]
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"), *carry)
