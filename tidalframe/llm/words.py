"""Tokenizing many texts by their pieces between safe boundaries.

A boundary is safe if no token can reach across it, so that the tokens of a text are
those of its pieces, one after another. Pieces repeat a lot, so a worker keeps the
tokens of the pieces it has met, up to a number of pieces, and gives only new pieces to
the library.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once; a single longer text is handled alone.
SLICE_BYTES = 2 << 20
# Parts of texts whose tokens a worker remembers, at most about so many: a part takes some
# 250 bytes. Parts that keep their case differ more.
REMEMBERED = {"words": 400_000, "spaced": 800_000}

# A single space between two characters that are no white space (a pattern's idea of
# white space may be narrower than this one: it then splits less, never wrongly).
SAFE = re.compile(r"(?<=\S) (?=\S)")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows again, cut so that no slice of two rows or more exceeds ``limit`` bytes of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            base = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a column, null as the empty text."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def segments(text: str, size: int = SLICE_BYTES) -> list[str]:
    """A long text cut at safe boundaries; a segment keeps the space it starts with."""
    out, start = [], 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    out.append(text[start:])
    return out


# Marks at the end of a word, after a plain letter or digit, are a token group of their own
# in a tokenizer that parts letters, digits and marks. Left out: the apostrophe, which may
# open a suffix, and the marks that special tokens' strings are made with.
PLAIN, MARKS = "[0-9A-Za-zÀ-ÖØ-öø-ÿ]", r"[!-&(-/:;=?@\[-`{}~]+"
# Words whose tokens may depend on the order in which they are composed and lowered: with
# accents apart from their letter, a capital sigma or dotted i, or a special token's string.
CASED = r"[\x{300}-\x{36f}\x{3a3}\x{130}]|<\|"
# White space other than single spaces and line ends between other characters.
UNEVEN = r"[ \n][ \n]|\A[ \n]|[ \n]\z|[\x{00}\t\v\f\r\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


class Words:
    """For a tokenizer that drops white space and ignores case: what lies between spaces and line ends."""

    @staticmethod
    def odd(texts: pa.Array) -> np.ndarray:
        return np.zeros(len(texts), bool)

    @staticmethod
    def pieces(texts: pa.Array) -> pa.Array:
        return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")

    @staticmethod
    def parts(pieces: pa.Array) -> pa.Array:
        plain = pc.replace_substring_regex(pc.utf8_lower(pieces), f"({PLAIN})({MARKS})$", r"\1 \2")
        return pc.split_pattern(pc.if_else(pc.match_substring_regex(pieces, CASED), pieces, plain), " ")


class Spaced:
    """For a tokenizer that joins a space to the word after it: words with their space, line ends and marks."""

    @staticmethod
    def odd(texts: pa.Array) -> np.ndarray:
        return pc.match_substring_regex(texts, UNEVEN).to_numpy(zero_copy_only=False)

    @staticmethod
    def pieces(texts: pa.Array) -> pa.Array:
        return pc.split_pattern(pc.replace_substring(texts, " ", "\0 "), "\0")

    @staticmethod
    def parts(pieces: pa.Array) -> pa.Array:
        apart = pc.replace_substring_regex(pieces, f"({PLAIN})({MARKS})(\n|$)", "\\1\0\\2\\3")
        return pc.split_pattern(pc.replace_substring(apart, "\n", "\0\n\0"), "\0")


def spaced_pieces(text: str) -> list[str]:
    """A text with any white space, cut before single spaces between other characters."""
    first, *rest = SAFE.split(text)
    return [first, *[" " + x for x in rest]]


# Bytes that part words: plain white space.
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes of a column of texts, where each text begins and the last one ends); null is empty."""
    filled = pc.fill_null(column, "")
    _, offsets, data = filled.buffers()
    width = np.int64 if pa.types.is_large_string(filled.type) else np.int32
    if not len(filled):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, width)[filled.offset : filled.offset + len(filled) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))[at[0] : at[-1]], at - at[0]


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the longest runs of marked bytes that lie within one text."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    own = at[:-1][at[1:] > at[:-1]]
    first[own] = inside[own]
    own = at[1:][at[1:] > at[:-1]] - 1
    last[own] = inside[own]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def different_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(number of each run of bytes in order of appearance, the different ones); ``inside`` marks their bytes."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    letters = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    coded = letters.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def split_words(column: pa.Array, blank: np.ndarray = BLANK, fold: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(number of each word, words of each text, the different words) of texts split at blank bytes.

    ``fold`` says what each byte counts as, before it is looked up in ``blank``.
    """
    data, at = text_bytes(column)
    data = data if fold is None else fold[data]
    inside = ~blank[data]
    starts, ends = runs(inside, at)
    numbers, different = different_runs(data, starts, ends, inside)
    return numbers, np.diff(np.searchsorted(starts, at)), different


class Numbers(dict):
    """Gives each new key the next number and lists the new keys."""

    def __init__(self):
        super().__init__()
        self.fresh: list = []

    def __missing__(self, key):
        self[key] = number = len(self)
        self.fresh.append(key)
        return number


class Store:
    """Runs of ids by number, one after another."""

    def __init__(self):
        self.ids, self.used, self.n = np.zeros(1 << 16, np.uint32), 0, 0
        self.starts, self.lens = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def add(self, ids: np.ndarray, lens: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.n + len(lens) > len(self.lens):
            self.lens, self.starts = (np.concatenate([x, np.zeros_like(x)]) for x in (self.lens, self.starts))
        self.ids[self.used : self.used + len(ids)] = ids
        self.lens[self.n : self.n + len(lens)] = lens
        self.starts[self.n : self.n + len(lens)] = self.used + np.cumsum(lens) - lens
        self.used, self.n = self.used + len(ids), self.n + len(lens)

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the runs in this order, length of each)."""
        lens = self.lens[numbers]
        return self.ids[expand(self.starts[numbers], lens)], lens


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of ``counts`` values."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], np.cumsum(counts)])])


def expand(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """starts[k], starts[k] + 1, ... of ``lens[k]`` numbers, one after another."""
    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(int(ends[-1]) if len(ends) else 0)


class PieceEncoder:
    """Token ids of texts by a ``tokenizers`` file, no special tokens added.

    Texts are split into pieces and the different pieces into parts, both at safe
    boundaries and by Arrow; only parts that are new go to the library.
    """

    def __init__(self, path: str, kind, remembered: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.kind, self.remembered = Tokenizer.from_file(path), kind, remembered
        self.parts, self.tokens = Numbers(), Store()
        self.elder: tuple[dict, Store] = ({}, Store())

    def known(self, parts: list[str]) -> np.ndarray:
        """Numbers of different parts; the tokens of new ones are asked for.

        Parts are remembered in two generations. When the younger is full it becomes the
        older, whose parts are taken over again as they are met; the rest is forgotten.
        """
        if len(self.parts) > self.remembered // 2:
            self.elder, self.parts, self.tokens = (self.parts, self.tokens), Numbers(), Store()
        numbers = np.fromiter(map(self.parts.__getitem__, parts), np.int64, len(parts))
        if fresh := self.parts.fresh:
            old = np.fromiter((self.elder[0].get(p, -1) for p in fresh), np.int64, len(fresh))
            new, ids, lens = np.flatnonzero(old < 0), [], np.zeros(len(fresh), np.int64)
            taken, lens[old >= 0] = self.elder[1].take(old[old >= 0])
            for at in range(0, len(new), 10_000):
                found = [x.ids for x in self.tokenizer.encode_batch_fast([fresh[k] for k in new[at : at + 10_000]], add_special_tokens=False)]
                lens[new[at : at + 10_000]] = own = np.fromiter(map(len, found), np.int64, len(found))
                ids.append(np.fromiter(chain.from_iterable(found), np.uint32, int(own.sum())))
            order = np.concatenate([np.flatnonzero(old >= 0), new])
            starts = np.empty(len(fresh), np.int64)
            starts[order] = np.cumsum(lens[order]) - lens[order]
            self.tokens.add(np.concatenate([taken, *ids])[expand(starts, lens)], lens)
            fresh.clear()
        return numbers

    def encode_pieces(self, split: pa.Array, apart: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each text) of texts split into pieces, these taken apart if that is safe."""
        coded = split.flatten().dictionary_encode()
        order, different = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
        if apart:
            parts = self.kind.parts(different)
            inner = parts.flatten().dictionary_encode()
            numbers = self.known(inner.dictionary.to_pylist())[inner.indices.to_numpy(zero_copy_only=False)]
            counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        else:
            numbers, counts = self.known(different.to_pylist()), np.ones(len(different), np.int64)
        held = counts[order]
        ids, lens = self.tokens.take(numbers[expand((np.cumsum(counts) - counts)[order], held)])
        return ids, sums(sums(lens, held), pc.list_value_length(split).to_numpy(zero_copy_only=False))

    def encode_slice(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        column = pa.array(texts, pa.string())
        odd = self.kind.odd(column)
        if not odd.any():
            return self.encode_pieces(self.kind.pieces(column), True)
        order = np.argsort(odd, kind="stable")
        even = column.take(pa.array(np.flatnonzero(~odd)))
        halves = [self.encode_pieces(self.kind.pieces(even), True)] if len(even) else []
        halves.append(self.encode_pieces(pa.array([spaced_pieces(texts[k]) for k in np.flatnonzero(odd)], pa.list_(pa.string())), False))
        ids, sorted_ = (np.concatenate(x) for x in zip(*halves, strict=True))
        lens, starts = np.empty_like(sorted_), np.empty_like(sorted_)
        lens[order], starts[order] = sorted_, np.cumsum(sorted_) - sorted_
        return ids[expand(starts, lens)], lens

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each text)."""
        found, owners, held, size = [], [], [], 0
        for k, text in enumerate(texts):
            for part in segments(text):
                if held and size + len(part) > SLICE_BYTES:
                    found.append(self.encode_slice(held))
                    held, size = [], 0
                held.append(part)
                owners.append(k)
                size += len(part)
        if held:
            found.append(self.encode_slice(held))
        totals = np.zeros(len(texts), np.int64)
        np.add.at(totals, np.array(owners, np.int64), np.concatenate([n for _, n in found] or [totals]))
        return np.concatenate([x for x, _ in found] or [np.zeros(0, np.uint32)]), totals


@lru_cache(maxsize=2)
def encoder(path: str, kind: str) -> PieceEncoder:
    """One encoder for each worker and file. kind: "words" or "spaced"."""
    return PieceEncoder(path, {"words": Words, "spaced": Spaced}[kind], REMEMBERED[kind])
