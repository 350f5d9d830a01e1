"""Benchmark passages in documents, found by an FM-index over each shard of the texts.

A shard is a run of documents with some number of words. Its different words are numbered;
a stretch of words that the searched phrases hold, long enough for the shortest phrase,
goes into the shard's text, anything else cannot be part of a match and is only a break in
it. The index is built once a shard, whatever the number of blocks that the phrases come
in. Phrases are searched backwards through ranks of a wavelet matrix over the
Burrows-Wheeler transform, all phrases of a block side by side, occurrences are placed by
walking to sampled suffix positions, and their spans are merged.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalframe.llm.store import new_file, read_file
from tidalframe.llm.wavelet import WaveletMatrix
from tidalframe.llm.words import slices, split_words
from tidalframe.session import scratch

WINDOW = 10
# Every so many-th position of the text is sampled.
SAMPLE = 8
# Bytes of text of a shard, and occurrences that are placed at once.
SHARD_BYTES, PLACED = 8 << 20, 1 << 20
# Items and bytes of the benchmark that are searched together, and blocks a worker keeps.
BLOCK_ITEMS, BLOCK_BYTES, KEPT = 20_000, 4 << 20, 4

# Bytes of words as themselves, A-Z as a-z, all others as a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


FOLDED = np.frombuffer(FOLD, np.uint8)
SPACED = np.arange(256) == 32


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by doubling the length they are ordered by.

    Zeros are breaks: each is smaller than any other symbol and than any later break, so
    no comparison goes beyond one.
    """
    n = len(text)
    breaks = text == 0
    rank = text.astype(np.int64) + int(breaks.sum())
    rank[breaks] = np.arange(int(breaks.sum()))
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        new = np.concatenate([[0], np.cumsum(sorted_[1:] != sorted_[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
        if new[-1] == n - 1 or step >= n:
            return order


class FMIndex:
    """Backward search and places of phrases in a text of symbols (0: a break, at least one at the end)."""

    def __init__(self, text: np.ndarray):
        order = suffix_array(text)
        self.n = len(text)
        self.bwt = WaveletMatrix.build(text[order - 1])
        counts = np.bincount(text)
        self.first = np.cumsum(counts) - counts
        # Also sampled: the start of each stretch, so that no walk meets a break.
        start = np.ones(self.n, bool)
        start[1:] = text[:-1] == 0
        sampled = (start | (np.arange(self.n) % SAMPLE == 0))[order]
        self.mark, self.place = np.concatenate([[0], np.cumsum(sampled)]), order[sampled]
        self.sampled = sampled

    def step(self, codes: np.ndarray, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self.first[symbols] + self.bwt.ranks(codes, i)

    def search(self, phrases: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffixes that start with each phrase (rows of symbols, ``lens`` of them used)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        codes = self.bwt.code(phrases.ravel()).reshape(phrases.shape)
        inside = phrases < len(self.first)
        for k in reversed(range(phrases.shape[1])):
            on = np.flatnonzero((k < lens) & (low < high))
            known = (codes[on, k] >= 0) & inside[on, k]
            high[on[~known]] = low[on[~known]]
            on = on[known]
            if len(on):
                low[on], high[on] = self.step(codes[on, k], phrases[on, k], low[on]), self.step(codes[on, k], phrases[on, k], high[on])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the text of suffixes given by their place in the order."""
        rows, steps, walking = rows.copy(), np.zeros(len(rows), np.int64), np.flatnonzero(~self.sampled[rows])
        while len(walking):
            symbols = self.bwt.access(rows[walking])
            rows[walking] = self.step(self.bwt.code(symbols), symbols, rows[walking])
            steps[walking] += 1
            walking = walking[~self.sampled[rows[walking]]]
        return self.place[self.mark[rows]] + steps


class Phrases:
    """The searched phrases: distinct windows of the items' words, and the items of each."""

    def __init__(self, items: list[tuple[int, str | None]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[int]] = {}
        self.items: list[int] = []
        for item, text in items:
            own = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(text)]
            if not own:
                continue
            self.items.append(item)
            for k in range(max(1, len(own) - window + 1)):
                found.setdefault(tuple(own[k : k + window]), set()).add(len(self.items) - 1)
        self.lens = np.array([len(p) for p in found], np.int64)
        self.phrases = np.zeros((len(found), window), np.int64)
        for k, p in enumerate(found):
            self.phrases[k, : len(p)] = p
        owners = [sorted(x) for x in found.values()]
        self.owner_start = np.cumsum([0, *map(len, owners)])
        self.owners = np.array([i for x in owners for i in x], np.int64)
        self.shortest = int(self.lens.min()) if len(self.lens) else 0
        self.vocabulary = pa.array(list(self.numbers), pa.large_binary())
        del self.numbers

    def numbered(self, different: pa.Array) -> np.ndarray:
        """For each of a shard's different words its number among the phrases' words, or 0."""
        return pc.fill_null(pc.index_in(different, value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1

    def translated(self, own: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrases in the shard's numbers, which they are) for those whose words are all there.

        ``own`` numbers the shard's words among the phrases' words, ``shard`` in the shard.
        """
        to = np.zeros(len(self.vocabulary) + 1, np.int64)
        to[own[own > 0]] = shard[own > 0]
        found = to[self.phrases]
        there = np.flatnonzero(((found > 0) | (self.phrases == 0)).all(axis=1))
        return found[there], there


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[k], start[k] + 1, ... of ``count[k]`` numbers, one after another."""
    ends = np.cumsum(count)
    return np.repeat(start - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)


def search_shard(ids: list[np.ndarray], sought: Phrases) -> tuple[list[list[int]], list[list[int]]]:
    """Documents of words numbered as the phrases' words are (0: none), and one block of phrases; see ``search``."""
    flat = np.concatenate([*ids, np.zeros(0, np.int64)])
    every = np.arange(len(sought.vocabulary) + 1)
    return search(flat, np.array([len(x) for x in ids], np.int64), sought.shortest, [(sought, every, every)])


def search(flat: np.ndarray, lens: np.ndarray, shortest: int, blocks) -> tuple[list[list[int]], list[list[int]]]:
    """Per document of a shard: merged spans of hit words (flat start, end pairs) and the items found.

    ``flat`` are the shard's words, 0 where no phrase holds the word, ``lens`` the words of
    each document. ``blocks`` gives (phrases, number of each different word of the shard
    among the phrases' words, and in ``flat``), one after another.
    """
    spans: list[list[int]] = [[] for _ in lens]
    items: list[list[int]] = [[] for _ in lens]
    doc = np.repeat(np.arange(len(lens)), lens)
    # Stretches of known words within a document that can hold the shortest phrase.
    known = flat > 0
    begins = known.copy()
    begins[1:] &= ~known[:-1] | (doc[1:] != doc[:-1])
    ends = known.copy()
    ends[:-1] &= ~known[1:] | (doc[1:] != doc[:-1])
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long = end - begin >= max(1, shortest)
    begin, size = begin[long], (end - begin)[long]
    if not len(begin):
        return spans, items
    at = np.cumsum(size + 1) - size - 1  # where each stretch begins in the text
    source = ranges(begin, size)
    text = np.zeros(int((size + 1).sum()), np.int64)
    place = ranges(at, size)
    text[place] = flat[source]
    origin = np.zeros(len(text), np.int64)
    origin[place] = source
    index = FMIndex(text)
    hits = np.zeros(len(flat) + 1, np.int32)
    for sought, own, shard in blocks:
        phrases, which = sought.translated(own, shard)
        found = index.search(phrases, sought.lens[which]) if len(which) else (np.zeros(0, np.int64),) * 2
        for d, item in placed(index, *found, which, sought, origin, doc, hits):
            items[d].append(item)
    hit = np.cumsum(hits[:-1]) > 0
    first, last = hit.copy(), hit.copy()
    first[1:] &= ~hit[:-1] | (doc[1:] != doc[:-1])
    last[:-1] &= ~hit[1:] | (doc[1:] != doc[:-1])
    offset = np.cumsum(lens) - lens
    for a, b in zip(np.flatnonzero(first).tolist(), np.flatnonzero(last).tolist(), strict=True):
        spans[doc[a]] += [a - int(offset[doc[a]]), b + 1 - int(offset[doc[a]])]
    return spans, items


def placed(index: FMIndex, low: np.ndarray, high: np.ndarray, which: np.ndarray, sought: Phrases, origin: np.ndarray, doc: np.ndarray, hits: np.ndarray) -> list[tuple[int, int]]:
    """(document, item) of the phrases found; adds the ends of their words to ``hits``.

    Occurrences are placed in blocks of suffix rows: a frequent phrase is spread over as
    many as it needs.
    """
    pairs = []
    matched = np.flatnonzero(high > low)
    counts = (high - low)[matched]
    total = np.cumsum(counts)
    for done in range(0, int(total[-1]) if len(total) else 0, PLACED):
        turn = np.arange(done, min(done + PLACED, int(total[-1])))
        own = np.searchsorted(total, turn, side="right")
        where = origin[index.locate(low[matched[own]] + turn - (total[own] - counts[own]))]
        phrase = which[matched[own]]
        np.add.at(hits, where, 1)
        np.add.at(hits, where + sought.lens[phrase], -1)
        seen = np.unique(doc[where] * len(sought.lens) + phrase)
        d, p = seen // len(sought.lens), seen % len(sought.lens)
        share = sought.owner_start[p + 1] - sought.owner_start[p]
        pairs.append(np.unique(np.repeat(d, share) * len(sought.items) + sought.owners[ranges(sought.owner_start[p], share)]))
    return [(x // len(sought.items), sought.items[x % len(sought.items)]) for x in (np.unique(np.concatenate(pairs)).tolist() if pairs else [])]


WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def cut_spans(text: str, spans: list[int]) -> str:
    """The text without the words of the spans; the words' ends, not the marks around them, bound a cut."""
    data = text.encode()
    bounds = [m.span() for m in WORD.finditer(data.translate(FOLD))]
    out, at = [], 0
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        out.append(data[at : bounds[a][0]])
        at = bounds[b - 1][1]
    return b"".join([*out, data[at:]]).decode()


def phrase_blocks(benchmark: DataFrame, window: int) -> list[str]:
    """Addresses of the benchmark's phrases, a file for each block of items; none for items without words.

    Tasks read the items and write the blocks; the driver sees the addresses.
    """
    base, most, size = scratch(benchmark.sparkSession, "phrases"), BLOCK_ITEMS, BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", size):
            for at in range(0, batch.num_rows, most):
                block = batch.slice(at, most)
                sought = Phrases(list(zip(block.column(0).to_pylist(), block.column(1).to_pylist(), strict=True)), window)
                if sought.items:
                    file, address = new_file(base, ".phrases")
                    file.write(pickle.dumps(sought))
                    file.close()
                    yield pa.RecordBatch.from_arrays([pa.array([address])], ["address"])

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return [r["address"] for r in rows.mapInArrow(run, "address string").collect()]


@lru_cache(maxsize=KEPT)
def phrases_at(address: str) -> Phrases:
    return pickle.loads(read_file(address))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", carried: tuple[str, ...] = ()) -> DataFrame:
    """Benchmark windows in every whole document, and the text without them.

    Returns doc_id, text (the hit spans removed), the carried columns as _c_<name>, n_words,
    n_hit, spans (merged, first word and the one after the last, in pairs) and items (ids
    of the items found, block by block in the benchmark's order). Items and documents without
    words have no windows; a null text stays null; repeated rows are each searched; an
    empty table gives no rows; a very long text is a shard of its own. Carried columns may
    have any name. The benchmark is the stated query set: tasks write it down in blocks of
    at most BLOCK_ITEMS items or about BLOCK_BYTES bytes, and a shard, indexed once, is
    searched for one block after another, so no task holds more than KEPT blocks.
    """
    blocks = phrase_blocks(benchmark, window)
    names = [f"_c_{c}" for c in carried]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"_c_{c}") for c in carried])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SHARD_BYTES):
            number, lens, different = split_words(batch.column(1), SPACED, FOLDED)
            different = different.cast(pa.large_binary())
            known, shortest = np.zeros(len(different), bool), window
            for address in blocks:
                known |= phrases_at(address).numbered(different) > 0
                shortest = min(shortest, phrases_at(address).shortest)
            own = np.cumsum(known) * known
            searched = ((phrases_at(address), phrases_at(address).numbered(different), own) for address in blocks)
            spans, items = search(own[number], lens, shortest, searched)
            hit = [sum(s[1::2]) - sum(s[::2]) for s in spans]
            left = batch.column(1)
            if any(spans):
                left = pa.array([cut_spans(t, s) if s else t for t, s in zip(left.to_pylist(), spans, strict=True)], pa.string())
            out = [batch.column(0), left, *batch.columns[2:], pa.array(lens, pa.int64()), pa.array(hit, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "text", *names, "n_words", "n_hit", "spans", "items"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[2:])
    return rows.mapInArrow(run, f"doc_id long, text string, {kept}n_words long, n_hit long, spans array<long>, items array<long>")


def digest(found: DataFrame) -> DataFrame:
    """The items as a count and a checksum: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    listed = F.array_join(F.array_sort(F.transform(F.array_distinct("items"), lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size(F.array_distinct("items")).cast("long").alias("n_items"), F.sha2(listed.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
