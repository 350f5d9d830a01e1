"""Phrases whose words keep together, mined relation by relation (SETM).

Texts are cut at marks into pieces and pieces into words. The relation of length k holds
(slice, place, phrase): where a frequent phrase of k words begins. A place counts the
words of a slice through all its pieces, with a number left free between two pieces, so
the next place is the adjacent position of the same piece and nothing else.

    1. The relation, sorted by place, is merge-joined with itself at adjacent places: two
       overlapping phrases of k words are a phrase of k + 1.
    2. Its groups are counted, first inside each slice, then over all slices.
    3. Only groups with enough occurrences are kept (a semi-join by slice), and the
       relation of length k + 1, sorted again, is written for the next length.

A phrase is no more frequent than its parts, so nothing that counts is lost. Slices are
runs of about ``SLICE_BYTES`` of text; their relations are Parquet files in the shared
folder, named by manifest tables that Spark commits, and a lost task writes new files.

Only counts of different phrases are shuffled, once a slice each: a phrase in every
document is one row per slice. Pairs of phrases are dealt by the first, its pairs in one
short run of bytes, and the pairs of a frequent first phrase by parts of the second, so
that no group to be counted stands for more than about ``PART`` occurrences.

Nulls, ties and odd input: a null text counts as empty, a null language as ``und``. Empty
texts, texts of marks only and repeated rows need no care: every row counts. A very long
text is cut between pieces; a piece, however long, stays whole. Ties in score and count
go by the phrase's bytes. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidalframe.llm.store import filesystem, new_file, partitions, written
from tidalframe.session import scratch

SLICE_BYTES = 16 << 20

# What a byte counts as: plain capitals as small letters, marks and line ends as line end, tab as space.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[list(b".,;:!?\n\x0b\x0c\r")] = 10
FOLD[9] = 32
ENDS = np.zeros(256, bool)
ENDS[list(b".,;:!?\n\x0b\x0c\r")] = True

# A slice's number: partition and place in it. A word's: its slice and place in that.
SLICE_BITS, LOCAL_BITS = 14, 30
# Occurrences of a first phrase whose pairs are counted together, and bytes of pairs at once.
PART, RUN_BYTES = 1 << 20, 4 << 20

COUNTS = "code long, lang string, word string, n long, address string"
PAIRS = "a long, part long, slice long, pairs binary"
HELD = "slice long, a long, b array<long>, id array<long>, heavy array<struct<id: long, parts: long>>, new array<struct<b: long, id: long, total: long>>"
# Numbers are those of one length, so a phrase is known by its length and number.
INNER = "array<struct<size: int, id: long>>"


def chunks(text: bytes, limit: int) -> Iterator[bytes]:
    """A text, cut after the first mark beyond each ``limit`` bytes."""
    start = 0
    while len(text) - start > limit:
        ends = np.flatnonzero(ENDS[np.frombuffer(text, np.uint8, min(len(text) - start - limit, limit), start + limit)])
        at, size = start + limit, limit
        while not len(ends) and at + size < len(text):
            at += size
            ends = np.flatnonzero(ENDS[np.frombuffer(text, np.uint8, min(len(text) - at, size), at)])
        if not len(ends):
            break
        stop = at + int(ends[0]) + 1
        yield text[start:stop]
        start = stop
    yield text[start:]


def slices(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list[str], list[bytes]]]:
    """(language, text) of the rows, in runs of about ``limit`` bytes."""
    langs, texts, size = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            for part in chunks(text, limit):
                langs.append(lang)
                texts.append(part)
                size += len(part)
                if size >= limit:
                    yield langs, texts
                    langs, texts, size = [], [], 0
    if texts:
        yield langs, texts


def encoded(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(number of each value in order of appearance, the different values)."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def words(langs: list[str], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """(place and number of each word, language and letters of each different word)."""
    data = FOLD[np.frombuffer(b"\n".join(texts), np.uint8)]
    inside = (data != 32) & (data != 10)
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, lens = edges[::2], edges[1::2] - edges[::2]
    places = np.arange(len(starts)) + np.searchsorted(np.flatnonzero(data == 10), starts)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lens, out=offsets[1:])
    letters = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    number, different = encoded(letters)
    lang_of, all_langs = encoded(pa.array(langs, pa.string()))
    first = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    spoken = lang_of[np.searchsorted(first, starts, side="right") - 1].astype(np.int64)
    local, both = encoded(pa.array(number.astype(np.int64) * len(all_langs) + spoken))
    both = both.to_numpy()
    return places, local, all_langs.take(pa.array(both % len(all_langs))), different.take(pa.array(both // len(all_langs))).cast(pa.string())


def store(base: str, places: np.ndarray, numbers: np.ndarray) -> str:
    """A relation, sorted by place, as a new file in the shared folder."""
    out, address = new_file(base, ".parquet")
    with out:
        table = pa.table({"place": places.astype(np.int64), "number": numbers.astype(np.int64)})
        pq.write_table(table, out, compression="zstd", use_dictionary=["number"], column_encoding={"place": "DELTA_BINARY_PACKED"}, write_statistics=False)
    return address


def load(address: str) -> tuple[np.ndarray, np.ndarray]:
    system, path = filesystem(address)
    table = pq.read_table(path, filesystem=system)
    return table.column("place").to_numpy(), table.column("number").to_numpy()


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bytes of each value): seven bits a byte, the highest bit of all but the last set."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        sizes += values >= np.uint64(1 << bits)
    at = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    for j in range(int(sizes.max()) if len(sizes) else 0):
        on = sizes > j
        more = (sizes[on] > j + 1).astype(np.uint8) << 7
        out[at[on] + j] = (values[on] >> np.uint64(7 * j) & np.uint64(127)).astype(np.uint8) | more
    return out, sizes


def from_varints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, where each begins)."""
    last = data < 128
    ends = np.flatnonzero(last) + 1
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    place = np.arange(len(data)) - np.repeat(starts, ends - starts)
    bits = (data & 127).astype(np.uint64) << (7 * place).astype(np.uint64)
    return (np.add.reduceat(bits, starts) if len(starts) else bits).astype(np.int64), starts


def adjacent(places: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The sorted relation merge-joined with itself at the next place.

    Gives place and group of each pair, and for each group, in order, its two phrases and
    how often it occurs. A place occurs once, so its partner can only be the next row.
    """
    at = np.flatnonzero(np.diff(places) == 1)
    phrase, code = np.unique(numbers, return_inverse=True)
    both, local, n = np.unique(code[at] * len(phrase) + code[at + 1], return_inverse=True, return_counts=True)
    return places[at], local, phrase[both // max(len(phrase), 1)], phrase[both % max(len(phrase), 1)], n


def first_relation(docs: DataFrame, lang: str, text: str, base: str, limit: int) -> DataFrame:
    """Rows (code of the slice, address) of the words' relations, and (code, lang, word, n) of their groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("code", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("address", pa.string())])
        task = TaskContext.get().partitionId() << SLICE_BITS
        for k, (langs, texts) in enumerate(slices(batches, limit)):
            if k >= 1 << SLICE_BITS:
                raise ValueError("a partition of too many slices: read the texts in smaller partitions")
            places, local, spoken, letters = words(langs, texts)
            if not len(places):
                continue
            n, code, none = len(letters), task + k << LOCAL_BITS, pa.nulls(1, pa.string())
            yield pa.record_batch([pa.array([code]), none, none, pa.nulls(1, pa.int64()), pa.array([store(base, places, local)])], schema=schema)
            counted = pa.array(np.bincount(local, minlength=n).astype(np.int64))
            yield pa.record_batch([pa.array(code + np.arange(n)), spoken, letters, counted, pa.nulls(n, pa.string())], schema=schema)

    read = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    return read.mapInArrow(run, COUNTS)


def numbers_of_task(tasks: int):
    """Gives a task's first, second, ... group numbers that no other task gives, with few gaps between them."""
    step = max(tasks, 1 << 10)

    def number(place: np.ndarray) -> np.ndarray:
        task = TaskContext.get().partitionId()
        if task >= step:
            raise ValueError(f"task {task} of {tasks}: the groups were dealt into more tasks than were asked for")
        return place * step + task

    return number


def frequent_words(counts: DataFrame, least: int, tasks: int) -> DataFrame:
    """(slice, local, id, total, first, lang, word) of the words that occur ``least`` times in their language.

    Numbers leave few gaps: the words of a task are numbered one by one, beside those of
    the other tasks. ``first`` marks one row of each, which alone names it.
    """
    own = Window.partitionBy("lang", "word").orderBy("code")
    every = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dealt = counts.select("code", "lang", "word", "n").repartition(tasks, "lang", "word")
    held = dealt.withColumn("total", F.sum("n").over(every)).withColumn("first", F.row_number().over(own) == 1).filter(F.col("total") >= least)
    named = [F.when(F.col("first"), F.col(c)).alias(c) for c in ("lang", "word")]
    mask = (1 << LOCAL_BITS) - 1
    rows = held.select(F.shiftright("code", LOCAL_BITS).alias("slice"), F.col("code").bitwiseAND(F.lit(mask)).alias("local"), "total", "first", *named)

    number = numbers_of_task(tasks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = -1
        for batch in batches:
            place = seen + np.cumsum(batch.column("first").to_numpy(zero_copy_only=False))
            seen = int(place[-1]) if len(place) else seen
            yield batch.append_column("id", pa.array(number(place)))

    return written(rows.mapInArrow(run, "slice long, local long, total long, first boolean, lang string, word string, id long"), "frequent_words")


def parts_of(ids: np.ndarray, heavy: dict[int, int]) -> np.ndarray:
    """Into how many parts the pairs of each first phrase are dealt."""
    parts = np.ones(len(ids), np.int64)
    if heavy:
        known = np.array(sorted(heavy))
        at = np.minimum(np.searchsorted(known, ids), len(known) - 1)
        hit = known[at] == ids
        parts[hit] = np.array([heavy[int(x)] for x in known])[at[hit]]
    return parts


def extended(relations: DataFrame) -> DataFrame:
    """(a, part, slice, pairs): the groups of adjacent phrases, counted in each slice.

    ``pairs`` holds the second phrases and the counts of one first phrase and part, each
    second phrase as its distance from the one before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, address, heavy in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _, _, a, b, n = adjacent(*load(address))
                parts = parts_of(a, {x["id"]: x["parts"] for x in heavy})
                part = b % parts
                if (parts > 1).any():
                    order = np.lexsort((b, part, a))
                    a, b, n, part = a[order], b[order], n[order], part[order]
                new = np.ones(len(a), bool)
                new[1:] = (a[1:] != a[:-1]) | (part[1:] != part[:-1])
                step = b.copy()
                step[1:] -= np.where(new[1:], 0, b[:-1])
                data, sizes = varints(np.stack([step, n], 1).ravel())
                at = np.concatenate([[0], np.cumsum(sizes)])[::2]
                first = np.flatnonzero(new)
                ends = np.append(at[first], at[-1])
                pairs = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(part[first]), pa.array(np.full(len(first), number)), pairs], ["a", "part", "slice", "pairs"])

    return relations.select("slice", "address", "heavy").mapInArrow(run, PAIRS)


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by (a, part), in runs of whole groups of about RUN_BYTES."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column("pairs").nbytes
        if size >= RUN_BYTES:
            rows = pa.Table.from_batches(held)
            cut = int(group_starts(rows)[-1])
            if cut:
                yield rows.slice(0, cut)
            # A copy, so that the rows given away can be freed.
            rest = rows.slice(cut).take(pa.array(np.arange(rows.num_rows - cut)))
            held, size = rest.to_batches(), sum(c.nbytes for c in rest.column("pairs").chunks)
    if held:
        yield pa.Table.from_batches(held)


def group_starts(rows: pa.Table) -> np.ndarray:
    a, part = rows.column("a").to_numpy(), rows.column("part").to_numpy()
    return np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (part[1:] != part[:-1])]))


def offsets(counts: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())


def structs(owner: np.ndarray, owners: np.ndarray, **fields: np.ndarray) -> pa.Array:
    """A list of structs for each of ``owners``, from values whose owners ascend."""
    held = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in fields.values()], list(fields))
    return pa.ListArray.from_arrays(offsets(np.diff(np.searchsorted(owner, np.append(owners, np.iinfo(np.int64).max)), prepend=0)[1:]), held)


def frequent_pairs(pairs: DataFrame, least: int, tasks: int) -> DataFrame:
    """(slice, a, b, id, heavy, new) of the pairs that occur ``least`` times: a row for each slice and first phrase.

    ``b`` and ``id`` list the second phrases and the pairs' numbers, ``heavy`` those whose
    own pairs need several parts, ``new`` the pairs that no row before has, with totals.
    """
    number, size = numbers_of_task(tasks), PART

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for rows in whole_groups(batches):
            starts = group_starts(rows)
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, rows.num_rows)))
            column = rows.column("pairs").combine_chunks().cast(pa.large_binary())
            ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            values, begins = from_varints(np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]])
            first = np.searchsorted(begins, ends - ends[0]) // 2
            b, n = values[::2], values[1::2]
            row = np.repeat(np.arange(rows.num_rows), np.diff(first))
            total = np.cumsum(b)
            b = total - (total[first[:-1]] - b[first[:-1]])[row]
            own = group[row]
            order = np.lexsort((b, own))
            new = np.ones(len(order), bool)
            new[1:] = (b[order][1:] != b[order][:-1]) | (own[order][1:] != own[order][:-1])
            at = np.flatnonzero(new)
            sums = np.add.reduceat(n[order], at)
            good = sums >= least
            which = np.cumsum(new) - 1
            place = seen + np.cumsum(good) - 1
            seen += int(good.sum())
            taken = np.flatnonzero(good[which])
            taken = taken[np.argsort(row[order[taken]], kind="stable")]
            at_row, ids, totals, seconds = row[order[taken]], number(place[which[taken]]), sums[which[taken]], b[order[taken]]
            filled, counts = np.unique(at_row, return_counts=True)
            several, fresh = totals > size, new[taken]
            lists = [pa.ListArray.from_arrays(offsets(counts), pa.array(x)) for x in (seconds, ids)]
            lists.append(structs(at_row[several], filled, id=ids[several], parts=1 + totals[several] // size))
            lists.append(structs(at_row[fresh], filled, b=seconds[fresh], id=ids[fresh], total=totals[fresh]))
            out = [pa.array(rows.column(c).to_numpy()[filled]) for c in ("slice", "a")]
            yield pa.RecordBatch.from_arrays([*out, *lists], ["slice", "a", "b", "id", "heavy", "new"])

    dealt = pairs.repartition(tasks, "a", "part").sortWithinPartitions("a", "part")
    return written(dealt.mapInArrow(run, HELD), "frequent_pairs")


def kept(relations: DataFrame, held: DataFrame, joined: bool, base: str, tasks: int) -> DataFrame:
    """(slice, address, heavy) of the next relations: places whose group is among the frequent ones.

    Both sides are dealt by slice; a slice's frequent groups are part of its own groups,
    so they fit where the slice did. ``heavy`` says how many parts the pairs of very
    frequent phrases are dealt into.
    """
    size = PART

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        heavy = pa.list_(pa.struct([("id", pa.int64()), ("parts", pa.int64())]))
        schema = pa.schema([("slice", pa.int64()), ("address", pa.string()), ("heavy", heavy)])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        places, local = load(left.column("address")[0].as_py())
        if joined:
            places, local, a, b, _ = adjacent(places, local)
            found = np.full(len(a), -1, np.int64)
            seconds, ids = (flat(right.column(c)) for c in ("b", "id"))
            firsts = np.repeat(right.column("a").to_numpy(), pc.list_value_length(right.column("b")).to_numpy())
            order = np.lexsort((seconds, firsts))
            found[pairs_at(a, b, firsts[order], seconds[order])] = ids[order]
            many = [x for c in right.column("heavy").to_pylist() for x in c]
        else:
            ids, parts = right.column("id").to_numpy(), 1 + right.column("total").to_numpy() // size
            found = np.full(int(local.max()) + 1, -1, np.int64)
            found[right.column("local").to_numpy()] = ids
            many = [{"id": int(x), "parts": int(p)} for x, p in zip(ids[parts > 1], parts[parts > 1], strict=True)]
        number = found[local]
        on = number >= 0
        return pa.table([left.column("slice").slice(0, 1), pa.array([store(base, places[on], number[on])]), pa.array([many], heavy)], schema=schema)

    left = relations.select("slice", "address").repartition(tasks, "slice").groupBy("slice")
    right = held.select("slice", *(("a", "b", "id", "heavy") if joined else ("local", "id", "total"))).repartition(tasks, "slice").groupBy("slice")
    return written(left.cogroup(right).applyInArrow(run, "slice long, address string, heavy array<struct<id: long, parts: long>>"), "phrase_relations")


def flat(column: pa.ChunkedArray) -> np.ndarray:
    """All values of a column of lists."""
    return pc.list_flatten(column).to_numpy()


def pairs_at(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Where the sorted pairs (c, d) stand among the sorted pairs (a, b), which hold them all."""
    both = np.lexsort((np.repeat([0, 1], [len(a), len(c)]), np.concatenate([b, d]), np.concatenate([a, c])))
    return (np.cumsum(both < len(a)) - 1)[both >= len(a)]


def described(groups: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases of the next length, from the shorter ones that begin and end them.

    heads and tails: occurrences of the first and last 1, 2, ... words; inner: the phrases
    of two words or more inside.
    """
    a, b = (shorter.select(*[F.col(c).alias(f"{side}_{c}") for c in shorter.columns]) for side in "ab")
    whole = groups.join(a, F.col("a") == F.col("a_id")).join(b, F.col("b") == F.col("b_id"))
    size = F.size("a_words")
    inside = F.when(size > 1, F.array(F.struct(size.alias("size"), F.col("a").alias("id")), F.struct(size.alias("size"), F.col("b").alias("id")))).otherwise(F.array().cast(INNER))
    return whole.select(
        "id",
        F.col("a_lang").alias("lang"),
        F.concat("a_words", F.slice("b_words", -1, 1)).alias("words"),
        "total",
        F.concat("a_heads", F.array("a_total")).alias("heads"),
        F.concat("b_tails", F.array("b_total")).alias("tails"),
        F.array_union(F.array_union("a_inner", "b_inner"), inside).alias("inner"),
    )


def best_cut(total: str, heads: str, tails: str) -> Column:
    """(score, k, l, r) of the cut with the lowest score, exact beyond 64 bits; ties to the smallest k."""
    size = F.size(heads)
    twice = F.col(total).cast("decimal(20,0)") * F.lit(2_000_000).cast("decimal(7,0)")

    def cut(k: Column) -> Column:
        left, right = F.col(heads)[k - 1], F.col(tails)[size - k]
        return F.struct(F.call_function("div", twice, (left + right).cast("decimal(20,0)")).alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    return F.array_min(F.transform(F.sequence(F.lit(1), size), cut))


def phrases(docs: DataFrame, least: int = 30, longest: int = 4, text: str = "text", lang: str = "lang", slice_bytes: int = SLICE_BYTES) -> tuple[DataFrame, DataFrame]:
    """(all frequent phrases of 1 to ``longest`` words as described, (lang, n) words of each language)."""
    base = scratch(docs.sparkSession, "phrases")
    first = written(first_relation(docs, lang, text, base, slice_bytes), "words")
    relations = first.filter("address IS NOT NULL").select(F.shiftright("code", LOCAL_BITS).alias("slice"), "address")
    counts = first.filter("address IS NULL")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    slices_ = max(1, relations.count())
    tasks = max(min(partitions(docs), slices_), slices_ // 64)
    held = frequent_words(counts, least, tasks)
    empty = F.array().cast("array<long>")
    level = held.filter("first").select("id", "lang", F.array("word").alias("words"), "total", empty.alias("heads"), empty.alias("tails"), F.array().cast(INNER).alias("inner"))
    found = [written(level, "phrases")]
    for k in range(1, longest):
        relations = kept(relations, held, k > 1, base, tasks)
        held = frequent_pairs(extended(relations.repartition(tasks)), least, tasks)
        found.append(written(described(held.select("a", F.inline("new")), found[-1]), "phrases"))
    out = found[0]
    for level in found[1:]:
        out = out.unionByName(level)
    return out, totals


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, share: int = 80, top: int = 2000, **names) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``longest`` words.

    The score of a phrase is that of its weakest cut, 2,000,000 a / (l + r). A phrase is
    dropped if a longer candidate around it has ``share`` percent of its occurrences.
    """
    every, totals = phrases(docs, least, longest, **names)
    candidates = every.filter(F.size("words") > 1)
    around = candidates.select(F.inline("inner"), F.col("total").alias("_longer")).groupBy("size", "id").agg(F.max("_longer").alias("_longer"))
    left = candidates.withColumn("size", F.size("words")).join(around, ["size", "id"], "left").filter(F.col("_longer").isNull() | (100 * F.col("_longer") < share * F.col("total")))
    scored = left.withColumn("cut", best_cut("total", "heads", "tails")).withColumn("phrase", F.concat_ws(" ", "words"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("total"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("total").alias("a"), "cut.l", "cut.r", "n", "cut.score")
