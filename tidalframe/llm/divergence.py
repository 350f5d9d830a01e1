"""Quality rules: how far a document's histograms lie from those of its language.

Two histograms are compared with the language's by Jensen-Shannon distance: classes of
characters, and the language's common words with one place for all others. Texts too
short for a histogram to mean much pass that comparison. The language's histograms are
sums over all documents that pass the base rules. How far a text may lie from its
language's words follows from the language: see ``word_limits``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidalframe.llm.words import different_runs, runs, slices, split_words, text_bytes

# Classes of bytes; a byte that continues a character has none.
LOWER, UPPER, DIGIT, SPACE, STOP, SYMBOL, OTHER, WIDE, CLASSES = range(9)
SYMBOLS = b"#*$%&|<>"


def _class(b: int) -> int:
    c = chr(b)
    if b >= 0x80:
        return WIDE if b >= 0xC0 else CLASSES
    if c in " \t\n\x0b\x0c\r":
        return SPACE
    if b in SYMBOLS:
        return SYMBOL
    return LOWER if c.islower() else UPPER if c.isupper() else DIGIT if c.isdigit() else STOP if c in ".,;:?'\"()-" else OTHER


CLASS_OF = np.array([_class(b) for b in range(256)], np.uint8)

# Common words of a language: how many; a document counts for those that it has at
# least LEAST_TIMES and that are at least LEAST_SHARE of its words.
COMMON = 32
LEAST_TIMES, LEAST_SHARE = 3, 0.01
# Largest distances, and the words a text and a language need for a comparison.
CLASS_DISTANCE, WORD_DISTANCE = 0.31, 0.42
CLASS_WORDS, COMMON_WORDS, LANGUAGE_WORDS = 20, 50, 2000
# Shares of the distance of a text without any common word: how far a text may lie that
# should have ENOUGH common words, and how far any text that can hardly lack them all by
# chance (once in 1 / RARE texts).
LONG_SHARE, SHARE, ENOUGH, RARE = 0.67, 0.98, 50, 1e-4
def repeated(ids: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Per document, the words inside 3-word windows that it has twice or more.

    Windows are grouped by a hash and the groups of two or more compared word by word.
    """
    n = len(ids)
    if n < 3:
        return np.zeros(n_docs, np.int64)
    with np.errstate(over="ignore"):
        key = doc.astype(np.uint64)
        for k in range(3):
            key[: n - 2] = (key[: n - 2] ^ ids[k : n - 2 + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key[: n - 2] ^= key[: n - 2] >> np.uint64(29)
    inside = np.flatnonzero(doc[: n - 2] == doc[2:])
    key = key[inside]
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(n_docs, np.int64)
    at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    found = inside[twice[at] == key]
    columns = (ids[found + 2], ids[found + 1], ids[found], doc[found])
    order = np.lexsort(columns)
    same = np.all([c[order][1:] == c[order][:-1] for c in columns], axis=0)
    again = np.zeros(len(found), bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[found[again] + k] = True
    return np.bincount(doc[covered], minlength=n_docs)


def repeated_lines(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per text, its lines with a word that are equal to an earlier line of it."""
    inside = data != 10
    starts, ends = runs(inside, at)
    number, different = different_runs(data, starts, ends, inside)
    before = np.concatenate([[0], np.cumsum(CLASS_OF[data] != SPACE)])
    some = before[ends] > before[starts]
    doc = np.searchsorted(at, starts[some], side="right") - 1
    once = np.unique(doc * max(1, len(different)) + number[some]) // max(1, len(different))
    n = len(at) - 1
    return np.bincount(doc, minlength=n) - np.bincount(once, minlength=n)


def lowered(words: pa.Array) -> pa.Array:
    """Words with plain capitals as small letters."""
    return pc.ascii_lower(words)


def measured(column: pa.Array) -> tuple:
    """(words as numbers, the different words, document of each word, words of each, byte classes of each)."""
    flat, lens, different = split_words(column)
    data, at = text_bytes(column)
    n = len(column)
    place = np.repeat(np.arange(n, dtype=np.int32) * (CLASSES + 1), np.diff(at)) + CLASS_OF[data]
    classes = np.bincount(place, minlength=n * (CLASSES + 1)).reshape(n, CLASSES + 1)[:, :CLASSES]
    return flat, different, np.repeat(np.arange(n), lens), lens, classes


def common_words(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The words that are common in most documents of a language: lang, place (from 1), word (lower case)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_pylist([{"lang": k[0], "word": k[1], "n": n} for k, n in counts.items()], schema=pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())]))
            counts.clear()
            return rows

        for batch in slices(batches, "text"):
            langs = batch.column(0).to_pylist()
            flat, different, doc, lens, _ = measured(batch.column(1))
            low = lowered(different).dictionary_encode()
            place, names = low.indices.to_numpy(zero_copy_only=False), low.dictionary
            n = max(1, len(names))
            key, times = np.unique(doc * n + place[flat], return_counts=True)
            d = key // n
            often = (times >= LEAST_TIMES) & (times >= LEAST_SHARE * lens[d])
            found = names.take(pa.array(key[often] % n)).cast(pa.large_binary()).to_pylist()
            counts.update((langs[a], word) for a, word in zip(d[often].tolist(), found, strict=True))
            if len(counts) > 100_000:
                yield out()
        yield out()

    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(run, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    # The first of each part, then the first of these: no task ranks all words of a language.
    counted = counted.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(256)))
    for keys in (["lang", "part"], ["lang"]):
        first = Window.partitionBy(*keys).orderBy(F.desc("n"), "word")
        counted = counted.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= COMMON)
    return counted.select("lang", "place", "word")


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
Common = dict[str, dict[bytes, int]]


def histograms(batch: pa.RecordBatch, langs: list[str], common: Common) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base counts, class histograms, word histograms) of the texts of a slice, a row each."""
    column = batch.column(batch.schema.get_field_index("text"))
    flat, different, doc, lens, classes = measured(column)
    low = lowered(different).cast(pa.large_binary())
    words = np.zeros((len(column), COMMON + 1), np.int64)
    for lang in set(langs):
        mine = np.array([x == lang for x in langs])[doc]
        if mine.any():
            known = pa.array(sorted(common.get(lang, {}), key=common.get(lang, {}).get), pa.large_binary())
            look = pc.fill_null(pc.index_in(low, value_set=known), COMMON).to_numpy(zero_copy_only=False)
            words += np.bincount(doc[mine] * (COMMON + 1) + look[flat[mine]], minlength=words.size).reshape(words.shape)
    lines = repeated_lines(*text_bytes(column))
    base = np.stack([lens, classes.sum(axis=1) - classes[:, SPACE], classes[:, SYMBOL], lines, repeated(flat, doc, len(column))], axis=1)
    return base.astype(np.int64), classes.astype(np.int64), words


def failed(base: np.ndarray) -> np.ndarray:
    """The base rules: fewer than 50 words, or over half of them in repeated windows."""
    return (base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0])


def language_sums(rows: DataFrame, common: Common) -> dict[str, np.ndarray]:
    """Per language the words, class counts and word counts of all documents that pass the base rules.

    A task adds its documents up by language; Spark adds the tasks' sums.
    """
    size = 1 + CLASSES + COMMON + 1
    names = [f"s{k}" for k in range(size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text"):
            langs = batch.column(1).to_pylist()
            base, classes, words = histograms(batch, langs, common)
            every = np.concatenate([base[:, :1], classes, words], axis=1)
            passed = ~failed(base)
            for lang in set(langs):
                own = np.array([x == lang for x in langs]) & passed
                sums[lang] = sums.get(lang, 0) + every[own].sum(axis=0)
        total = np.array(list(sums.values()), np.int64).reshape(-1, size)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), *[pa.array(total[:, k]) for k in range(size)]], ["lang", *names])

    added = rows.mapInArrow(run, "lang string, " + ", ".join(f"{n} long" for n in names)).groupBy("lang").agg(*[F.sum(n).alias(n) for n in names])
    return {r["lang"]: np.array(r[1:], np.int64) for r in added.collect()}


def distances(own: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances (base 2, from 0 to 1) of histograms from one, nan where either is empty."""
    with np.errstate(divide="ignore", invalid="ignore"):
        p = own / own.sum(axis=1, keepdims=True)
        q = reference / reference.sum()
        m = (p + q) / 2
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return np.sqrt(np.maximum(0, parts.sum(axis=1) / 2))


def word_limits(n_words: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Largest word distances of texts with so many words from a language's word histogram.

    With a share c of common words in the language, a text of n words should have n * c of
    them, and the chance in its distance falls with the root of that. A text without any
    has a distance that c alone fixes; the limit is a share of this one: LONG_SHARE from
    ENOUGH expected words on, more for shorter texts, SHARE at most. Where a text of the
    language may well have no common word, and anywhere above it, WORD_DISTANCE holds.
    """
    without = np.zeros((1, COMMON + 1))
    without[0, COMMON] = 1
    share = reference[:COMMON].sum() / max(1, reference.sum())
    expected = np.maximum(n_words * share, 1e-9)
    own = distances(without, reference)[0] * np.minimum(SHARE, LONG_SHARE * np.sqrt(np.maximum(1, ENOUGH / expected)))
    return np.where((1 - share) ** n_words < RARE, np.minimum(WORD_DISTANCE, own), WORD_DISTANCE)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", carried: tuple[str, ...] = ()) -> DataFrame:
    """Base rules and distances from the language for every whole document.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, class_distance, word_distance, kept and, as _c_<name>, the carried
    columns. base_failed: fewer than 50 words, or over half of them in repeated windows.
    A document that passes is kept unless one of the distances is over its limit
    (CLASS_DISTANCE, and for words that of ``word_limits``); the class distance counts from CLASS_WORDS words on, the word distance from COMMON_WORDS,
    and either where the language has LANGUAGE_WORDS in documents that passed. A null or
    empty text has no words and fails the base rules; documents without a language form
    one of their own; ties between common words go to the smaller one; repeated rows are
    judged alike; an empty table gives no rows. The driver sees COMMON words and a row of
    sums for each language. The texts are read three times rather than kept in between.
    """
    common: Common = {}
    for r in common_words(docs, lang_col, text_col).collect():
        common.setdefault(r["lang"], {})[bytes(r["word"])] = r["place"] - 1
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(lang_col), F.lit("")).alias("_lang"), F.col(text_col).alias("text"), *[F.col(c).alias(f"_c_{c}") for c in carried if c != text_col])
    sums = language_sums(rows.select("doc_id", "_lang", "text"), common)
    names = rows.columns[2:]
    kept = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[2:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            langs = batch.column(1).to_pylist()
            base, classes, words = histograms(batch, langs, common)
            far, word_limit = np.full((2, len(langs)), np.nan), np.full(len(langs), WORD_DISTANCE)
            for lang in set(langs):
                total = sums.get(lang)
                if total is None or total[0] < LANGUAGE_WORDS:
                    continue
                own = np.array([x == lang for x in langs])
                word_limit[own] = word_limits(base[own, 0], total[1 + CLASSES :])
                for k, (held, reference, least) in enumerate(((classes, total[1 : 1 + CLASSES], CLASS_WORDS), (words, total[1 + CLASSES :], COMMON_WORDS))):
                    on = own & (base[:, 0] >= least)
                    far[k, on] = distances(held[on], reference)
            bad = failed(base)
            good = ~bad & ~(far[0] > CLASS_DISTANCE) & ~(far[1] > word_limit)
            gaps = [pa.array(x, pa.float64(), mask=np.isnan(x)) for x in far]
            columns = [batch.column(0), *[pa.array(base[:, k]) for k in range(len(BASE))], pa.array(bad), *gaps, pa.array(good), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *BASE, "base_failed", "class_distance", "word_distance", "kept", *names])

    counts = ", ".join(f"{b} long" for b in BASE)
    out = rows.mapInArrow(run, f"doc_id long, {counts}, base_failed boolean, class_distance double, word_distance double, kept boolean{kept}")
    carry = [F.col("text" if c == text_col else f"_c_{c}").alias(f"_c_{c}") for c in carried]
    return out.select("doc_id", *BASE, "base_failed", "class_distance", "word_distance", "kept", *carry)
