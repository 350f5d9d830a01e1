"""Toxicity by a factorization machine over hashed terms.

The score of a text is a bias, a weight for each of its terms, and for each pair of its
terms the product of their factor vectors, so that two terms that mean little alone can
mean much together. Terms are words in lower case, numbered by a hash; the machine is
fitted on those terms whose frequency differs most between the labels, and on those that
tell the labels apart only together with another term.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalframe.llm.learning import Adam, chosen, held_out, log_loss, sample, sigmoid, temperature
from tidalframe.llm.store import written
from tidalframe.llm.words import Numbers, slices

BUCKETS = 1 << 18
# Labelled rows, terms of all of them together and different terms the machine is fitted
# on, at most, and length of a factor.
FITTED, FITTED_TERMS, TERMS, FACTORS = 20_000, 24_000_000, 4096, 8
ROUNDS, RATE, DECAY = 160, 0.05, 2e-4
# Terms alone are screened by deviations of their share (ALONE); pairs among the PAIRED most
# frequent terms by deviations of their joint effect from the sum of both (TOGETHER).
ALONE, PAIRED, TOGETHER, PAIR_TEXTS, PAIR_ROWS = 2.5, 2048, 6.0, 1 << 11, 256
LIMIT = 0.5
WORD = re.compile(r"[^\W\d_]+")


def terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct buckets of each text, which text each is of, ascending). Each distinct word is taken apart once."""
    numbers = Numbers()
    look = numbers.__getitem__
    words = [t.lower().split() for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    index = np.fromiter((n for w in words for n in map(look, w)), np.int64, int(counts.sum()))
    found = [[xxhash.xxh3_64_intdigest(p) % BUCKETS for p in WORD.findall(w)] for w in numbers]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    flat = np.fromiter((b for x in found for b in x), np.int64, int(sizes.sum()))
    key = np.unique(np.repeat(np.arange(len(texts)), counts) * max(1, len(found)) + index)
    doc, word = key // max(1, len(found)), key % max(1, len(found))
    lens = sizes[word]
    ends = np.cumsum(lens)
    own = flat[np.repeat((np.cumsum(sizes) - sizes)[word] - (ends - lens), lens) + np.arange(int(ends[-1]) if len(ends) else 0)]
    both = np.unique(np.repeat(doc, lens) * BUCKETS + own)
    return both % BUCKETS, both // BUCKETS


@dataclass
class Machine:
    """number: for each bucket its place among the machine's terms, or -1."""

    number: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    factor: np.ndarray
    heat: float = 1.0

    def parts(self, term: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(logits, sums of factors) of n texts; ``term`` are places, ``doc`` whose each is."""
        linear = np.bincount(doc, weights=self.weight[term], minlength=n)
        # A factor at a time: no table of all terms of the texts and their factors is held.
        sums = np.stack([np.bincount(doc, weights=v[term], minlength=n) for v in self.factor.T.copy()], axis=1)
        squares = np.bincount(doc, weights=(self.factor * self.factor).sum(axis=1)[term], minlength=n)
        return self.bias[0] + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def score(self, buckets: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        term = self.number[buckets]
        known = term >= 0
        return sigmoid(self.parts(term[known], doc[known], n)[0] / self.heat)


def paired(buckets: np.ndarray, doc: np.ndarray, toxic: np.ndarray, train: np.ndarray) -> np.ndarray:
    """Terms that matter with another one: the share of toxic texts with both is not what the shares with each alone add up to.

    All pairs of the PAIRED most frequent terms are looked at, by products of the matrix of
    texts and terms, PAIR_TEXTS texts at a time.
    """
    times = np.bincount(buckets, minlength=BUCKETS)
    asked = np.argsort(-times, kind="stable")[:PAIRED]
    asked = asked[times[asked] >= 20]
    place = np.full(BUCKETS, -1, np.int64)
    place[asked] = np.arange(len(asked))
    k, known = len(asked), place[buckets] >= 0
    column, row, which = place[buckets[known]].astype(np.int32), doc[known], np.flatnonzero(train)
    # Whole counts of at most FITTED texts, so single precision holds them.
    both, both_toxic = np.zeros((k, k), np.float32), np.zeros((k, k), np.float32)
    for at in range(0, len(which), PAIR_TEXTS):
        texts = which[at : at + PAIR_TEXTS]
        on = (row >= texts[0]) & (row <= texts[-1])
        x = np.zeros((texts[-1] - texts[0] + 1, k), np.float32)
        x[row[on] - texts[0], column[on]] = 1
        both += x.T @ x
        x = x[toxic[texts[0] : texts[-1] + 1]]
        both_toxic += x.T @ x
    one, one_toxic = np.diag(both).astype(float), np.diag(both_toxic).astype(float)
    n, n_toxic = max(1, len(which)), int(toxic[which].sum())
    matters = np.zeros(k, bool)
    for at in range(0, k, PAIR_ROWS):  # some rows of the pairs at a time
        part = slice(at, at + PAIR_ROWS)
        mine, mine_toxic = one[part, None], one_toxic[part, None]
        cells = [
            (both[part], both_toxic[part]),
            (mine - both[part], mine_toxic - both_toxic[part]),
            (one[None] - both[part], one_toxic[None] - both_toxic[part]),
            (n - mine - one[None] + both[part], n_toxic - mine_toxic - one_toxic[None] + both_toxic[part]),
        ]
        effect, variance = np.zeros(both[part].shape), np.zeros(both[part].shape)
        for sign, (held, bad) in zip((1, -1, -1, 1), cells, strict=True):
            share = (bad + 0.5) / (held + 1)
            effect += sign * share
            variance += share * (1 - share) / np.maximum(held, 1)
        enough = np.min([held for held, _ in cells], axis=0) >= 20
        enough[np.arange(len(enough)), np.arange(at, at + len(enough))] = False
        matters[part] = (enough & (np.abs(effect) > TOGETHER * np.sqrt(variance))).any(axis=1)
    return asked[matters]


def fit(buckets: np.ndarray, doc: np.ndarray, y: np.ndarray, seed: int = 13) -> Machine:
    """A machine by full-batch Adam on four fifths of the texts, its round and temperature chosen on the rest."""
    rng = np.random.default_rng(seed)
    n, y = len(y), y.astype(np.float64)
    number = np.full(BUCKETS, -1, np.int64)
    if n == 0:
        return Machine(number, np.zeros(1), np.zeros(1), np.zeros((1, FACTORS)))
    test = np.zeros(n, bool)
    test[rng.permutation(n)[: n // 5]] = True
    train = ~test
    # Terms by how many deviations their share in toxic texts lies from that in the others.
    on, pos = train[doc], train & (y > 0.5)
    a = np.bincount(buckets[on & pos[doc]], minlength=BUCKETS).astype(float)
    b = np.bincount(buckets[on], minlength=BUCKETS) - a
    n1, n0 = max(1, int(pos.sum())), max(1, int(train.sum() - pos.sum()))
    p = (a + b + 1) / (n1 + n0 + 2)
    z = np.abs(a / n1 - b / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    z[a + b < 3] = 0
    chosen = np.argsort(-z, kind="stable")[:TERMS]
    chosen = chosen[z[chosen] > ALONE]
    joint = np.setdiff1d(paired(buckets[on], doc[on], y > 0.5, train), chosen)
    chosen = np.concatenate([chosen[: TERMS - len(joint)], joint])
    number[chosen] = np.arange(len(chosen))
    m = max(1, len(chosen))
    share = np.clip(pos.sum() / max(1, train.sum()), 1e-3, 1 - 1e-3)
    machine = Machine(number, np.array([np.log(share / (1 - share))]), np.zeros(m), rng.normal(0, 0.05, (m, FACTORS)))
    term = number[buckets]
    held = term >= 0
    term, doc = term[held].astype(np.int32), doc[held].astype(np.int32)
    fitted = train[doc]
    ft, fd = term[fitted], doc[fitted]
    adam, best, waited = Adam([machine.bias, machine.weight, machine.factor], RATE), (np.inf, None), 0
    for _ in range(ROUNDS):
        logit, sums = machine.parts(ft, fd, n)
        d = np.where(train, sigmoid(logit) - y, 0) / max(1, train.sum())
        own = d[fd]
        gw = np.bincount(ft, weights=own, minlength=m)
        gv = np.stack([np.bincount(ft, weights=own * (sums[:, k][fd] - machine.factor[:, k][ft]), minlength=m) for k in range(FACTORS)], axis=1)
        adam.step([np.array([d.sum()]), gw + DECAY * machine.weight, gv + DECAY * machine.factor])
        loss = log_loss(y[test], machine.parts(term, doc, n)[0][test]) if test.any() else 0.0
        waited += 1
        if loss < best[0]:
            best, waited = (loss, [x.copy() for x in (machine.bias, machine.weight, machine.factor)]), 0
        if waited > 25:
            break
    machine.bias, machine.weight, machine.factor = best[1]
    machine.heat = temperature(y[test], machine.parts(term, doc, n)[0][test])
    return machine


def bounded(learnt: DataFrame, most: int, parts: int = 1024) -> DataFrame:
    """The rows of the first parts, by a hash of the id, that have at most ``most`` terms together, the first part at least."""
    part = F.pmod(F.xxhash64("doc_id"), F.lit(parts))
    sizes = learnt.groupBy(part.alias("part")).agg(F.sum(F.size("terms")).alias("n")).collect()
    total, upto = 0, parts
    for part_, n in sorted((r["part"], r["n"]) for r in sizes):
        total += n
        if total > most:
            upto = max(part_, 1)
            break
    return learnt.filter(part < upto)


def toxicity_scores(docs: DataFrame, labels: DataFrame, limit: float = LIMIT, fitted: int = FITTED, fitted_terms: int = FITTED_TERMS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores every whole text: doc_id, held_out, score (near 1: toxic), predicted.

    The machine is fitted on at most ``fitted`` labelled documents that are not held out,
    and on fewer, in the order of a hash, where these have over ``fitted_terms`` different
    terms each, added up. A very long text has no more terms than there are buckets. A null or empty text has no terms and the score of the bias; without any label the
    score is 0.5; repeated rows score alike; a null id is never held out nor learnt from;
    an empty table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            bucket, doc = terms([t or "" for t in batch.column(1).to_pylist()])
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=batch.num_rows))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bucket.astype(np.int32)))], ["doc_id", "terms"])

    known = written(chosen(labels, "toxic", fitted), "labels")
    texts = rows.join(F.broadcast(known.select("label_id")), F.col("doc_id") == F.col("label_id"), "left_semi")
    learnt = written(sample(texts.mapInArrow(listed, "doc_id long, terms array<int>"), known, "terms"), "terms")
    learnt = bounded(learnt, fitted_terms).orderBy("doc_id").toArrow()
    held = learnt.column("terms").combine_chunks()
    sizes = pc.list_value_length(held).to_numpy(zero_copy_only=False)
    bucket, label = held.flatten().to_numpy(zero_copy_only=False), learnt.column("label").to_numpy()
    machine = spark.sparkContext.broadcast(fit(bucket, np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), label))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            bucket, doc = terms([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(machine.value.score(bucket, doc, batch.num_rows))], ["doc_id", "score"])

    scored = rows.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))
