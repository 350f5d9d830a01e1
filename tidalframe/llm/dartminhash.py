"""DartMinHash signatures of weighted sets, and near duplicates by banded joins on them.

Every element owns a strip of the plane of weight and time, on which darts fall at random
but always alike, as a hash of the element says. A set sees the darts below its element's
weight, in order of time; each dart names a coordinate, and the earliest dart of each
coordinate is the signature. Two sets agree in a coordinate with the probability of their
weighted Jaccard similarity. A set throws about k log k darts beyond one for each element.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidalframe.llm.store import met, written
from tidalframe.llm.words import slices, split_words

SHINGLE, THRESHOLD = 5, 0.8
# Coordinates: at a similarity of 0.8 a pair shares none of 36 bands of 6 coordinates
# once in 55,000 pairs; at 0.5 it shares one in 4 of 10 cases, which the exact check ends.
BANDS, ROWS = 36, 6
# Bits of a document's parity map. The ones in the difference of two maps are never more
# than the shingles that only one of two texts has, so they rule out a pair for certain.
PARITY = 1024

MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """A hash of 64 bits to 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def signatures(elements: np.ndarray, weights: np.ndarray | None, owner: np.ndarray, n: int, k: int) -> np.ndarray:
    """Signatures (n by k) of n weighted sets; ``owner`` says whose each element is, ascending.

    ``weights`` None: all 1, in which case an element listed twice counts once. Each unit
    of an element's weight is a strip of its own; in the last one the darts that lie above
    the weight are left out. Sets without elements get the largest value everywhere. A
    coordinate is the earliest dart: its time in the high half, what it is in the low one.
    """
    if weights is not None:
        units = np.ceil(weights).astype(np.int64)
        strip = np.arange(int(units.sum())) - np.repeat(np.cumsum(units) - units, units)
        room = np.repeat(weights, units) - strip
        owner, elements = np.repeat(owner, units), mixed(np.repeat(elements, units) + strip.astype(np.uint64) * MIX[0])
        total = np.bincount(owner, weights=np.minimum(room, 1), minlength=n)
    else:
        room, total = None, np.bincount(owner, minlength=n).astype(float)
    out = np.full(n * k, np.iinfo(np.uint64).max, np.uint64)
    until = k * (np.log(k) + 2.5) / np.maximum(total, 1e-300)
    missing = np.flatnonzero(total > 0)
    while len(missing):
        chosen = np.zeros(n, bool)
        chosen[missing] = True
        on = np.flatnonzero(chosen[owner])
        seed, time, last = elements[on], np.zeros(len(on)), until[owner[on]]
        whose, most = owner[on], None if room is None else room[on]
        while len(seed):
            # The gap to the next dart on a strip is exponential, so darts fall evenly in time.
            seed = mixed(seed + MIX[0])
            time = time - np.log(((seed >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53)
            early = time <= last
            if not early.any():
                break
            seed, time, last, whose = seed[early], time[early], last[early], whose[early]
            most = None if most is None else most[early]
            dart = mixed(seed ^ MIX[2])
            key = whose * k + ((dart >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
            value = (time.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (dart & np.uint64(0xFFFFFFFF))
            if most is not None:
                below = (mixed(dart) >> np.uint64(11)).astype(np.float64) * 2.0**-53 < most
                key, value = key[below], value[below]
            np.minimum.at(out, key, value)
        gaps = (out.reshape(n, k) == np.iinfo(np.uint64).max).any(axis=1)
        missing = missing[gaps[missing]]
        until[missing] *= 2
    return out.reshape(n, k)


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """One key for each band of ``rows`` coordinates."""
    n, k = signature.shape
    parts, keys = signature.reshape(n, k // rows, rows), np.repeat(np.arange(k // rows, dtype=np.uint64)[None], n, axis=0)
    for j in range(rows):
        keys = mixed(keys * MIX[0] + parts[:, :, j])
    return keys


def occurrences(keys: np.ndarray, times: np.ndarray) -> np.ndarray:
    """A key of its own for every occurrence of each key."""
    strip = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    return mixed(np.repeat(keys, times) + strip.astype(np.uint64) * MIX[0])


def parity(keys: np.ndarray, times: np.ndarray | None, owner: np.ndarray, n: int) -> np.ndarray:
    """Per set a bit for each of PARITY places: whether an odd count of its elements lies there."""
    if times is not None:
        owner, keys = np.repeat(owner, times), occurrences(keys, times)
    place = owner * PARITY + (mixed(keys) % np.uint64(PARITY)).astype(np.int64)
    odd = np.bincount(place, minlength=n * PARITY).reshape(n, PARITY) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(">u8").astype(np.int64)


# White space beyond the plain kind.
WHITE = r"[\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def lowered(texts: pa.Array) -> pa.Array:
    """Texts in lower case, all white space plain."""
    low = pc.utf8_lower(pc.fill_null(texts, ""))
    return pc.replace_substring_regex(low, WHITE, " ") if pc.any(pc.match_substring_regex(low, WHITE)).as_py() else low


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the runs of ``size`` words of all texts, which text each is of).

    Words are what lies between white space, in lower case; a text of fewer words, but not
    none, is one run. Only different words are hashed.
    """
    number, lens, different = split_words(lowered(texts))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, different.cast(pa.large_binary()).to_pylist()), np.uint64, len(different))
    flat = hashes[number]
    ends = np.cumsum(lens)
    upto, place = np.repeat(ends, lens), np.arange(len(flat))
    with np.errstate(over="ignore"):
        key, whole = np.zeros(len(flat), np.uint64), upto - place >= size
        padded = np.concatenate([flat, np.zeros(size, np.uint64)])
        for j in range(size):
            key = mixed(key * MIX[0] + np.where(place + j < upto, padded[j : j + len(flat)], np.uint64(j + 1)))
    short = (lens < size) & (lens > 0)
    take = whole.copy()
    take[(ends - lens)[short]] = True
    owner = np.repeat(np.arange(len(lens)), lens)
    return key[take], owner[take]


def distinct(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys of each owner in order, their owners, how often each occurs)."""
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    return keys[at], owner[at], np.diff(np.append(at, len(keys)))


def signed(docs: DataFrame, weighted: bool, bands_: int = BANDS, rows_: int = ROWS) -> DataFrame:
    """Per row of (uid, doc_id, text): uid, doc_id, digest of the text, weight (of its shingles), parity map, bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 19):
            texts = [x or "" for x in batch.column(2).to_pylist()]
            keys, owner, times = distinct(*shingles(batch.column(2)))
            with np.errstate(over="ignore"):
                signature = signatures(keys, times.astype(float) if weighted else None, owner, len(texts), bands_ * rows_)
                weight = np.bincount(owner, weights=times if weighted else None, minlength=len(texts)).astype(np.int64)
                full = weight > 0
                held = bands(signature, rows_).view(np.int64)
                drawn = parity(keys, times if weighted else None, owner, len(texts))
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.int64())) for x in (drawn, held)]
            lists[1] = pa.array([x if f else [] for x, f in zip(lists[1].to_pylist(), full, strict=True)], pa.list_(pa.int64())) if not full.all() else lists[1]
            digest = pa.array([xxhash.xxh3_128_digest(t.encode()) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), digest, pa.array(weight), *lists], ["uid", "doc_id", "digest", "weight", "parity", "bands"])

    return docs.select("uid", "doc_id", "text").mapInArrow(run, "uid long, doc_id long, digest binary, weight long, parity array<long>, bands array<long>")


def shingle_sets(texts: DataFrame, weighted: bool) -> DataFrame:
    """Per row of (uid, text) its distinct shingles; ``weighted``: each occurrence of one counts as another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys, owner, times = distinct(*shingles(batch.column(1)))
            if weighted:
                with np.errstate(over="ignore"):
                    keys, owner = occurrences(keys, times), np.repeat(owner, times)
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=batch.num_rows))]), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64)))], ["uid", "keys"])

    return texts.select("uid", "text").mapInArrow(run, "uid long, keys array<long>")


def similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Of pairs (a, b) of text numbers those whose shingles' similarity reaches ``threshold``."""
    one, two = ([F.col("uid").alias(x), F.col("keys").alias(f"k{x}")] for x in "ab")
    joined = pairs.hint("merge").join(sets.select(*one), "a").hint("merge").join(sets.select(*two), "b")
    counted = joined.select("a", "b", (F.size("ka") + F.size("kb")).alias("every"), F.size(F.array_intersect("ka", "kb")).alias("common"))
    return counted.filter(F.col("common") >= threshold * (F.col("every") - F.col("common"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """The smallest number connected with each number in a link: uid, class (its own smallest excepted).

    Star contraction: in turn every number links its larger neighbours, then its smaller
    ones, to the smallest of them, until nothing changes. Only minima per number are
    aggregated, so a number may have any count of links.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()
        edges = written(small, "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("uid"), F.col("v").alias("class"))
        seen = state


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, weighted: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Classes of documents linked by near-equal texts: doc_id, class_id, class_size, first.

    Texts are linked if their shingles (runs of five words) have a Jaccard similarity of
    ``threshold`` or more, with ``weighted`` one that counts each shingle as often as it
    occurs. Equal texts are one from the start. Every band key has a centre, and a text is
    first checked against one centre of its keys; where a key then still holds texts of
    different classes, rounds of new centres close it (``close_keys``), so no link within
    a key is lost and hardly any pair within a class is made. class_id is
    the smallest doc_id of the class, class_size its number of documents, first marks one
    of them, that with the smallest id. Empty texts are equal; texts without words are
    linked to equal texts only; a document with null text is a class of its own; null ids
    come last in a class; repeated rows are a class of copies; an empty table gives no
    rows; other columns are not looked at.
    """
    return classes(numbered_rows(docs, id_col, text_col), threshold, weighted).drop("uid")


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD, weighted: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are the first of their class, all columns as they were; see ``near_duplicates``.

    The others are left out by their numbers, which Spark sends to the documents if they
    are few and else meets them by a shuffle.
    """
    rows = numbered_rows(docs, id_col, text_col, tuple(c for c in docs.columns if c not in (id_col, text_col)))
    out = written(classes(rows, threshold, weighted).filter(~F.col("first")).select("uid"), "left_out")
    kept = rows.join(out, "uid", "left_anti")
    back = {id_col: F.col("doc_id").cast(docs.schema[id_col].dataType), text_col: F.col("text")}
    return kept.select(*[back.get(c, F.col(f"_c_{c}")).alias(c) for c in docs.columns])


def numbered_rows(docs: DataFrame, id_col: str, text_col: str, carried: tuple[str, ...] = ()) -> DataFrame:
    """Documents with a number for each row, written down so that the numbers stay."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"_c_{c}") for c in carried])
    return written(rows.withColumn("uid", F.monotonically_increasing_id()), "documents")


def classes(rows: DataFrame, threshold: float, weighted: bool) -> DataFrame:
    """Per numbered row: uid, doc_id, class_id, class_size, first."""
    marks = written(signed(rows.filter(F.col("text").isNotNull()), weighted), "signatures")
    first = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "uid")
    groups = written(marks.groupBy("digest").agg(F.min("uid").alias("text_id"), F.count(F.lit(1)).alias("copies"), F.min(first).alias("head")), "texts")
    heads = marks.join(groups.select(F.col("text_id").alias("uid")), "uid", "left_semi")
    keys = heads.select("uid", F.posexplode("bands").alias("band", "key")).select("uid", F.xxhash64("band", "key").alias("key"))
    turn = F.struct(F.xxhash64("uid").alias("h"), F.col("uid").alias("uid"))
    shared = keys.groupBy("key").agg(F.min(turn).alias("low"), F.max(turn).alias("high")).filter("low.uid <> high.uid").select("key", "low")
    # No side of these joins has a bound on its size, so none may be broadcast.
    members = written(keys.hint("merge").join(shared, "key"), "members")
    centres = members.groupBy("uid").agg(F.min("low").alias("low")).select("uid", F.col("low.uid").alias("centre"))
    sets = written(shingle_sets(rows.hint("merge").join(centres.select("uid"), "uid", "left_semi"), weighted), "shingles")
    profile = heads.select("uid", "weight", *[F.col("parity")[k].alias(f"p{k}") for k in range(PARITY // 64)])
    tried = worth(pair(centres.filter("uid <> centre"), "uid", "centre"), profile, threshold)
    links = written(similar(tried, sets, threshold), "similar")
    return labelled(rows, marks, groups, close_keys(members.select("key", "uid"), profile, sets, links, threshold))


def close_keys(members: DataFrame, profile: DataFrame, sets: DataFrame, links: DataFrame, threshold: float) -> DataFrame:
    """Classes after every pair of texts of different classes that shares a key has been checked.

    A key is open while texts outside its largest class have not been centres of it. In
    each round the first such texts of each open key, four times as many as in the last round,
    are checked against all texts of other classes there that have not been centres; then
    classes merge and closed keys leave. So a group of copies, most of which hang together
    by a few centres, costs a small multiple of its size, and only texts that are like
    none of the others are compared with all of them.
    """
    found, place = components(links), members.withColumn("done", F.lit(False))
    most = 4
    while True:
        placed = written(place.hint("merge").join(found, "uid", "left").select("key", "uid", "done", F.coalesce("class", "uid").alias("class")), "placed")
        held = placed.groupBy("key", "class").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(~F.col("done"), 1)).alias("new"))
        size = F.struct("n", "class", "new")
        keys = held.groupBy("key").agg(F.max(size).alias("top"), F.sum("new").alias("new")).filter(F.col("new") > F.col("top.new"))
        # Keys with a text outside the largest class that has not been a centre.
        open_ = placed.hint("merge").join(keys.select("key", F.col("top.class").alias("main")), "key").hint("merge").join(profile, "uid")
        open_ = written(open_, "open")
        if open_.isEmpty():
            return found
        turn = Window.partitionBy("key").orderBy(F.xxhash64("uid"), "uid")
        centres = open_.filter("NOT done AND class <> main").withColumn("turn", F.row_number().over(turn)).filter(F.col("turn") <= most)
        centres = written(centres.drop("turn", "done", "main"), "centres")
        x, y = centres.alias("x"), open_.filter("NOT done").alias("y")
        match = (F.col("x.key") == F.col("y.key")) & (F.col("x.class") != F.col("y.class")) & near("x", "y", threshold)
        asked = pair(x.hint("merge").join(y, match).select(F.col("x.uid").alias("p"), F.col("y.uid").alias("q")), "p", "q")
        more = written(similar(asked, sets, threshold), "similar")
        if not more.isEmpty():
            found = components(found.select(F.col("uid").alias("a"), F.col("class").alias("b")).union(more))
        was = centres.select("key", "uid", F.lit(True).alias("was"))
        place = open_.select("key", "uid", "done").hint("merge").join(was, ["key", "uid"], "left").select("key", "uid", (F.col("done") | F.coalesce("was", F.lit(False))).alias("done"))
        most *= 4


def pair(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def near(x: str, y: str, threshold: float):
    """Whether weights and parity maps of two sides of a join allow the similarity. It never rules out one that has it."""
    differ = sum((F.bit_count(F.col(f"{x}.p{k}").bitwiseXOR(F.col(f"{y}.p{k}"))) for k in range(PARITY // 64)), F.lit(0))
    a, b = F.col(f"{x}.weight"), F.col(f"{y}.weight")
    return (a >= threshold * b) & (b >= threshold * a) & (differ <= F.floor((a + b) * (1 - threshold) / (1 + threshold) + 1e-6))


def worth(pairs: DataFrame, profile: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose weights and parity maps allow the similarity."""
    x, y = profile.alias("x"), profile.alias("y")
    joined = pairs.hint("merge").join(x, F.col("a") == F.col("x.uid")).hint("merge").join(y, F.col("b") == F.col("y.uid"))
    return joined.filter(near("x", "y", threshold)).select("a", "b")


def labelled(rows: DataFrame, marks: DataFrame, groups: DataFrame, found: DataFrame) -> DataFrame:
    """Every document with its class: classes are made of texts, and copies take that of their text."""
    texts = groups.hint("merge").join(found.withColumnRenamed("uid", "text_id"), "text_id", "left")
    texts = written(texts.select("digest", "copies", "head", F.coalesce("class", "text_id").alias("_class")), "classed")
    heads = texts.groupBy("_class").agg(F.count(F.lit(1)).alias("_texts"), F.min("head").alias("_head"), F.min("head.doc_id").alias("class_id"), F.sum("copies").alias("class_size"))
    by_text = met(texts.select("digest", "copies", "_class"), written(heads, "heads"), "_class", "_texts")
    every = met(marks.select("uid", "doc_id", "digest"), written(by_text.select("digest", "copies", "_head", "class_id", "class_size"), "texts"), "digest", "copies")
    known = every.select("uid", "doc_id", "class_id", "class_size", (F.col("uid") == F.col("_head.uid")).alias("first"))
    alone = rows.filter(F.col("text").isNull()).select("uid", "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("first"))
    return known.unionByName(alone)
