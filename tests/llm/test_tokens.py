"""Packing, token files and token counts against the libraries and by round trip."""

from __future__ import annotations

import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import frame
from tidalframe.llm import packing, token_counts, token_files, wavelet, words
from tidalframe.llm.queries import tokenizer

ALPHABET = ["a", "B", "a.", "b, ", "_,", "İ", "Σ", "ΑΣ ", "K", "...", "<|ENDOFTEXT|>", ". ", "ſ", "ẞ", "Ǆ", " ", "  ", "\n", "\t", "'s", "é", "▁", "<|endoftext|>", "1", "22", "!", "　", "\x1c", "́", "ﬁ", "😀", "-", " x"]


def odd_texts(n: int = 1500) -> list[str]:
    rng = random.Random(3)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 30))) for _ in range(n)]


def whole(name: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer(name))


@pytest.mark.parametrize(("name", "kind"), [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "spaced")])
def test_pieces_give_the_ids_of_whole_texts(name, kind, monkeypatch):
    monkeypatch.setattr(words.segments, "__defaults__", (40,))
    texts = odd_texts()
    encoder = words.PieceEncoder(tokenizer(name), {"words": words.Words, "spaced": words.Spaced}[kind], remembered=50)
    library = whole(name)
    for at in range(0, len(texts), 200):
        ids, lens = encoder.encode(texts[at : at + 200])
        want = [library.encode(t, add_special_tokens=False).ids for t in texts[at : at + 200]]
        assert [x.tolist() for x in np.split(ids, np.cumsum(lens)[:-1])] == want


def test_segments_give_the_counts_of_whole_texts():
    model = token_counts.load(tokenizer("piece_bpe_32k.model"))
    texts = odd_texts() + ["word " * 9000]
    assert token_counts.count_texts(model, texts) == [len(model.encode(t)) for t in texts]


def test_token_counts_of_odd_rows(spark, odd, odd_rows, nothing):
    path = tokenizer("piece_bpe_32k.model")
    model = token_counts.load(path)
    got = token_counts.token_counts(odd, path).collect()
    want = [(r[0], len((r[1] or "").encode()), len(model.encode(r[1] or ""))) for r in odd_rows]
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == Counter(want)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
    assert token_counts.token_counts(nothing, path).count() == 0


def packed_right(rows, capacity):
    places = defaultdict(list)
    for r in rows:
        assert 0 < r.length <= capacity
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing_of_odd_rows(spark, odd, odd_rows, nothing):
    path = tokenizer("word_bpe_49k.json")
    packed = packing.pack(odd, path, keep_ids=True)
    rows, library = packed.collect(), whole("word_bpe_49k.json")
    packed_right(rows, 2048)
    got = defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.start == 2048 * r.piece and len(r.ids) == r.length
        got[r.doc_id].append(tuple(r.ids))
    want = defaultdict(list)
    for r in odd_rows:
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 0]
        want[r[0]] += [tuple(ids[k : k + 2048]) for k in range(0, len(ids), 2048)]
    assert {k: Counter(v) for k, v in got.items()} == {k: Counter(v) for k, v in want.items()}
    joined = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in joined) == sum(r.length for r in rows)
    assert packing.pack(nothing, path).count() == 0


def test_a_hot_length_is_numbered_without_gaps(spark):
    rows = spark.range(5000).selectExpr("id as doc_id", "0 as piece", "0L as start", "cast(if(id % 3 = 0, 7, id % 90 + 1) as long) as length", "0L as ids_crc32")
    placed = packing.place(rows, capacity=90).collect()
    assert len(placed) == 5000
    counts = np.bincount([r.length for r in placed], minlength=91)
    assert packing.lower_bound(counts, 90) <= packed_right(placed, 90) <= 1837 < sum(n for _, n in packing.best_fit(dict(Counter(r.length for r in placed)), 90))


def test_fullest_fillings_against_all_sums():
    rng = random.Random(12)
    for _ in range(200):
        pieces = Counter(rng.randint(1, 30) for _ in range(rng.randint(1, 12)))
        counts = np.zeros(41, np.int64)
        for x, n in pieces.items():
            counts[x] = n
        room, sums = rng.randint(1, 40), {0}
        for x in pieces.elements():
            sums |= {y + x for y in sums}
        found = [(items, total) for items, total in packing.Sums(counts, room).fullest()]
        assert found[0][1] == max(y for y in sums if y <= room) and [t for _, t in found] == sorted((t for _, t in found), reverse=True)
        assert {t for _, t in found} == {y for y in sums if y <= room}
        assert all(sum(items) == total and not Counter(items) - pieces for items, total in found)
        packed = packing.fullest_first(counts, 40, rng.random() < 0.5)
        assert Counter(x for items, n in packed for x in items * n) == pieces and all(sum(items) <= 40 for items, _ in packed)


def fewest(sizes, capacity):
    """The fewest bins, by trying every place for every piece."""
    best = len(sizes)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(sizes):
            best = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + sizes[k] <= capacity and bins[j] not in bins[:j]:
                go(k + 1, bins[:j] + [bins[j] + sizes[k]] + bins[j + 1 :])
        go(k + 1, [*bins, sizes[k]])

    go(0, [])
    return best


def test_fillings_beyond_the_first_are_tried():
    """A packing that neither best fit nor the first fillings of each node find."""
    counts = {21: 1, 32: 2, 22: 4, 16: 1}
    patterns = packing.solve(counts, 100)
    assert sum(n for _, n in patterns) == 2 and all(sum(items) <= 100 for items, _ in patterns)
    placed = Counter()
    for items, n in patterns:
        placed.update({x: k * n for x, k in Counter(items).items()})
    assert placed == counts


def test_solver_against_all_packings():
    rng = random.Random(5)
    found = wanted = 0
    for _ in range(60):
        sizes = sorted((rng.randint(1, 20) for _ in range(9)), reverse=True)
        patterns = packing.solve(dict(Counter(sizes)), 20)
        assert Counter(x for items, n in patterns for x in items for _ in range(n)) == Counter(sizes)
        assert all(sum(items) <= 20 for items, _ in patterns)
        best = fewest(sizes, 20)
        counts = np.bincount(sizes, minlength=21)
        assert packing.lower_bound(counts, 20) <= best
        assert best <= sum(n for _, n in packing.best_fit(dict(Counter(sizes)), 20))
        found, wanted = found + sum(n for _, n in patterns), wanted + best
    assert found == wanted


def test_search_beats_best_fit_where_that_is_not_best():
    counts = {44: 100, 26: 100, 30: 100, 33: 100, 37: 100, 30 + 1: 100, 18: 50, 12: 30}
    plain = sum(n for _, n in packing.best_fit(counts, 100))
    assert sum(n for _, n in packing.solve(counts, 100)) <= plain


def test_search_holds_one_count_of_pieces():
    rng = random.Random(4)
    counts = np.zeros(2049, np.int64)
    for _ in range(6000):
        counts[min(2048, int(rng.lognormvariate(5.5, 0.8)) + 1)] += 1
    tracemalloc.start()
    found = packing.complete(counts, 2048, 10**9, packing.lower_bound(counts, 2048) - 1, 300, 6)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6e6  # 300 nodes with a count of each length were 25 MB
    assert found is None or Counter(x for items, n in found for x in items * n) == {x: int(n) for x, n in enumerate(counts) if n}


@pytest.mark.parametrize("n", [0, 1, 64, 65, 3000])
def test_wavelet_matrix(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 70, n).astype(np.uint32) * 700
    matrix = wavelet.block_matrix(memoryview(wavelet.block_bytes(ids)))
    assert (matrix.decode() == ids).all() and (matrix.access(np.arange(n)) == ids).all()
    for token in [*rng.choice(ids, 5).tolist(), 13] if n else [13]:
        at = np.flatnonzero(ids == token)
        assert matrix.count(token) == len(at)
        assert [matrix.select(token, j) for j in range(min(4, len(at)))] == at[:4].tolist()
        assert [matrix.rank(token, i) for i in (0, n // 2, n)] == [(at < i).sum() for i in (0, n // 2, n)]


def test_token_files_of_odd_rows(spark, odd, odd_rows, nothing, monkeypatch):
    path, library = tokenizer("byte_bpe_50k.json"), whole("byte_bpe_50k.json")
    monkeypatch.setattr(token_files, "BLOCK", 1000)
    manifest = token_files.write_shards(odd, path)
    rows = sorted(token_files.read_documents(manifest).collect(), key=lambda r: r.start)
    want = [(r[0], [*library.encode(r[1] or "", add_special_tokens=False).ids, 2]) for r in odd_rows]
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == Counter((d, len(i), crc(i)) for d, i in want)
    assert [r.doc_id is not None for r in rows] == sorted(r.doc_id is not None for r in rows)
    ids = [r.doc_id for r in rows if r.doc_id is not None]
    assert ids == sorted(ids)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    assert token_files.token_files(nothing, path).count() == 0


def test_shard_file_answers(spark):
    from tidalframe.llm.store import read_file

    texts = [f"the cat {k} sat on the mat" for k in range(40)]
    manifest = token_files.write_shards(frame(spark, list(enumerate(texts))), tokenizer("byte_bpe_50k.json")).orderBy("part", "seq").collect()
    library, every = whole("byte_bpe_50k.json"), []
    for text in texts:
        every += [*library.encode(text, add_special_tokens=False).ids, 2]
    at = 0
    for row in manifest:
        shard = token_files.Shard(read_file(row.address))
        own = every[at : at + row.n_tokens]
        assert shard.access(range(len(own))).tolist() == own
        assert list(shard.occurrences(own[0])) == [k for k, x in enumerate(own) if x == own[0]]
        assert shard.count(2) == row.n_docs and shard.count(50_000) == own.count(50_000)
        at += row.n_tokens
    assert at == len(every)
