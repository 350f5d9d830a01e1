"""Best-fit packing of documents into fixed-length sequences by bin completion.

Documents of one length are interchangeable, so the packing is found on the number of
documents of each length (never more numbers than a sequence has tokens, at any corpus
size) as patterns with a repeat count, and is then dealt out to the pieces in parallel:
pieces are numbered within their length, and each run of equal pattern places takes a
run of those numbers.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalframe.llm.store import numbered, written
from tidalframe.llm.words import encoder, slices, texts_of

CAPACITY = 2048
END_ID = 0
# Nodes of the search beyond the best-fit solution, and fillings tried at each before all are.
NODES = 4000
WIDTH = 6

Pattern = tuple[tuple[int, ...], int]  # lengths in one sequence, number of such sequences


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing: each piece, largest first, to the fullest sequence it fits.

    Sequences of equal content are kept as one entry with a count. As the fullest
    sequence stays the fullest until the next piece of that length no longer fits, it
    takes as many as fit at once.
    """
    room: dict[int, list[Pattern]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        for free in sorted(f for f in room if f >= length):
            fits, same = free // length, []
            for items, times in room.pop(free):
                full = min(times, left // fits)
                if full:
                    room.setdefault(free - fits * length, []).append((items + (length,) * fits, full))
                    left, times = left - full * fits, times - full
                if left and times:
                    room.setdefault(free - left * length, []).append((items + (length,) * left, 1))
                    left, times = 0, times - 1
                if times:
                    same.append((items, times))
            if same:
                room[free] = same
            if not left:
                break
        fits = capacity // length
        for k, n in ((fits, left // fits), (left % fits, 1)):
            if k and n:
                room.setdefault(capacity - k * length, []).append(((length,) * k, n))
    return [p for group in room.values() for p in group]


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: by total length, and by the pieces that no two can share.

    For each k: pieces over capacity - k are alone, those over half are one each, and
    pieces of k or more that do not fit beside these need sequences of their own.
    """
    lengths = np.arange(len(counts), dtype=np.int64)
    n, total = np.cumsum(counts), np.cumsum(counts * lengths)
    best = -(-int(total[-1]) // capacity)
    half = capacity // 2
    k = np.arange(1, half + 1)
    alone = n[-1] - n[capacity - k]
    big, big_sum = n[capacity - k] - n[half], total[capacity - k] - total[half]
    small_sum = total[half] - total[k - 1]
    more = np.maximum(0, -(-(small_sum - (big * capacity - big_sum)) // capacity))
    return max(best, int((alone + big + more).max())) if len(k) else best


class Sums:
    """Which totals pieces at hand can make, as bits, from the smallest lengths on."""

    def __init__(self, counts: np.ndarray, room: int):
        self.counts, self.lengths = counts, [int(x) for x in np.flatnonzero(counts[: room + 1]) if x]
        self.reached, mask = [1], (1 << room + 1) - 1
        for x in self.lengths:
            bits, left, step = self.reached[-1], min(int(counts[x]), room // x), 1
            while left > 0:
                n = min(step, left)
                bits |= bits << n * x & mask
                left, step = left - n, 2 * step
            self.reached.append(bits)

    def largest_first(self, total: int, below: int) -> tuple[int, ...]:
        """Pieces of the first ``below`` lengths that make ``total``, the largest possible ones first."""
        out: list[int] = []
        while total:
            below = min(below, bisect_right(self.lengths, total))
            x = self.lengths[below - 1]
            below -= 1
            for n in range(min(int(self.counts[x]), total // x), 0, -1):
                if self.reached[below] >> total - n * x & 1:
                    out += [x] * n
                    total -= n * x
                    break
        return tuple(out)

    def fullest(self) -> Iterator[tuple[tuple[int, ...], int]]:
        """(filling, total), the fullest first, among these those with the largest first piece."""
        totals, top = self.reached[-1], self.reached[-1].bit_length()
        for total in range(top - 1, -1, -1):
            if not totals >> total & 1:
                continue
            if not total:
                yield (), 0
            for at in range(bisect_right(self.lengths, total) - 1, -1, -1):
                x = self.lengths[at]
                for n in range(min(int(self.counts[x]), total // x), 0, -1):
                    if self.reached[at] >> total - n * x & 1:
                        yield (x,) * n + self.largest_first(total - n * x, at), total


def dominated(items: tuple[int, ...], waste: int, counts: np.ndarray) -> bool:
    """Whether one of the pieces, or none, could be exchanged for a larger one within the waste."""
    used = Counter(items)
    larger = {int(y) for x in {0, *items} for y in np.flatnonzero(counts[x + 1 : x + waste + 1]) + x + 1} if waste else ()
    return any(counts[y] > used[y] for y in larger)


def fillings(counts: np.ndarray, room: int, width: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` with pieces at hand, least waste first, ``width`` at most.

    Looked at are the fullest ones, four for each that is asked for. One is dominated, and
    left out, if one of its pieces could be exchanged for a larger one within the waste:
    the larger piece would otherwise need more room elsewhere.
    """
    found = list(islice(Sums(counts, room).fullest(), 4 * width))
    kept = [items for items, total in found if not dominated(items, room - total, counts)]
    return kept[:width] or [found[0][0]]


def fullest_first(counts: np.ndarray, capacity: int, halves: bool) -> list[Pattern]:
    """A packing that fills each sequence around the largest piece left as full as can be.

    A sequence is repeated as often as its pieces last, or with ``halves`` half as often.
    """
    left, out = counts.copy(), []
    while left.any():
        largest = int(np.flatnonzero(left)[-1])
        left[largest] -= 1
        items = Counter((largest, *next(Sums(left, capacity - largest).fullest())[0]))
        left[largest] += 1
        times = min(int(left[x]) // m for x, m in items.items())
        times = -(-times // 2) if halves else times
        for x, m in items.items():
            left[x] -= m * times
        out.append((tuple(items.elements()), times))
    return out


def all_fillings(counts: np.ndarray, have: list[int], room: int) -> Iterator[tuple[int, ...] | None]:
    """Every undominated filling of ``room``, one after another, and None for each step that gives none.

    ``have`` lists the lengths at hand, in order. Complete and dominated are meant as in
    ``fillings``. ``counts`` must be the same at every step.
    """

    def grow(left: int, upto: int, items: Counter) -> Iterator[tuple[int, ...] | None]:
        for at in range(min(upto, bisect_right(have, left)) - 1, -1, -1):
            x = have[at]
            for n in range(min(int(counts[x]), left // x), 0, -1):
                yield from grow(left - n * x, at, items | Counter({x: n}))
        larger = (y for x in (0, *items) for y in have[bisect_right(have, x) : bisect_right(have, x + left)])
        yield None if any(counts[y] > items[y] for y in larger) else tuple(sorted(items.elements(), reverse=True))

    return grow(room, bisect_right(have, room), Counter())


Repeated = tuple[tuple[tuple[int, int], ...], int]  # (length, how many of it) in one sequence, number of such sequences


class Path:
    """Sequences chosen one after another, and the pieces that they leave: one array, whatever the depth."""

    def __init__(self, counts: np.ndarray):
        self.left, self.chosen = counts.copy(), []

    def add(self, pattern: Repeated) -> None:
        self.chosen.append(pattern)
        for x, m in pattern[0]:
            self.left[x] -= m * pattern[1]

    def cut(self, depth: int) -> None:
        """Back to the first ``depth`` choices."""
        while len(self.chosen) > depth:
            items, times = self.chosen.pop()
            for x, m in items:
                self.left[x] += m * times


def written_out(patterns: list[Repeated]) -> list[Pattern]:
    return [(tuple(x for x, m in items for _ in range(m)), times) for items, times in patterns]


def complete_all(counts: np.ndarray, capacity: int, incumbent: int, target: int, nodes: int) -> list[Pattern] | None:
    """Bin completion as in ``complete``, of all undominated fillings and numbers of repeats, found one by one.

    A sequence is repeated as often as its pieces last, and else used once before the next
    is chosen. Every step of an enumeration counts as a node.
    """
    path, have = Path(counts), [int(x) for x in np.flatnonzero(counts) if x]
    left = path.left

    def options() -> Iterator[Repeated | None]:
        """Of the pieces left now; whenever it is asked again, the same ones must be left."""
        largest, end = int(np.flatnonzero(left)[-1]), object()
        every = all_fillings(left, have, capacity - largest)
        while True:
            left[largest] -= 1
            filling = next(every, end)
            left[largest] += 1
            if filling is end:
                return
            if filling is None:
                yield None
                continue
            items = tuple(Counter((largest, *filling)).items())
            times = min(int(left[x]) // m for x, m in items)
            yield items, times
            if times > 1:
                yield items, 1

    if not counts.any():
        return None
    best, stack = None, [(0, options())]
    while stack and nodes > 0 and incumbent > target:
        used, tried = stack[-1]
        path.cut(len(stack) - 1)
        option = next(tried, ())
        if option == ():
            stack.pop()
            continue
        nodes -= 1
        if option is None:
            continue
        path.add(option)
        used += option[1]
        if used + lower_bound(left, capacity) >= incumbent:
            continue
        if left.any():
            stack.append((used, options()))
        else:
            best, incumbent = list(path.chosen), used
    return best and written_out(best)


def complete(counts: np.ndarray, capacity: int, incumbent: int, target: int, nodes: int, width: int) -> list[Pattern] | None:
    """Depth-first bin completion; a packing of fewer sequences than ``incumbent``, if it finds one.

    Each node fills a sequence around the largest piece left, for ``width`` undominated
    fillings in turn, and repeats that sequence as often as its pieces last. A node whose
    sequences so far and lower bound for the rest reach the incumbent is pruned. The
    search ends at ``target``, a proven bound, or after ``nodes`` nodes. If it has tried
    all that before, the nodes left go to all fillings. A node waits as its last sequence
    and its depth; the pieces it leaves are counted when its turn comes.
    """
    best, path, stack = None, Path(counts), [(0, 0, None)]
    left = path.left
    while stack and nodes > 0:
        depth, used, pattern = stack.pop()
        path.cut(depth)
        if pattern:
            path.add(pattern)
        nodes -= 1
        have = np.flatnonzero(left)
        if not len(have):
            if used < incumbent:
                best, incumbent = list(path.chosen), used
                if used <= target:
                    break
            continue
        if used + lower_bound(left, capacity) >= incumbent:
            continue
        largest = int(have[-1])
        left[largest] -= 1
        options = fillings(left, capacity - largest, width)
        left[largest] += 1
        for filling in reversed(options):
            items = tuple(Counter((largest, *filling)).items())
            times = min(int(left[x]) // m for x, m in items)
            stack.append((len(path.chosen), used + times, (items, times)))
    wider = complete_all(counts, capacity, incumbent, target, nodes) if incumbent > target else None
    return wider or (written_out(best[::-1]) if best else None)


def solve(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES, width: int = WIDTH) -> list[Pattern]:
    """Patterns for pieces counted by length.

    Best-fit decreasing and, where it misses the bound, packings of the fullest sequences
    are the incumbents; bin completion then looks for a better one.
    """
    packed = best_fit({x: n for x, n in counts.items() if n}, capacity)
    array = np.zeros(capacity + 1, np.int64)
    for x, n in counts.items():
        array[x] = n
    bound = lower_bound(array, capacity)
    sequences = lambda patterns: sum(n for _, n in patterns)
    for halves in (False, True):
        if sequences(packed) > bound:
            packed = min(packed, fullest_first(array, capacity, halves), key=sequences)
    better = complete(array, capacity, sequences(packed), bound, nodes, width) if sequences(packed) > bound else None
    return better or packed


def runs(patterns: list[Pattern]) -> tuple[np.ndarray, ...]:
    """Places by length: sorted keys (length, first number), and the sequence and offset each run starts with."""
    rows, seen, first = [], Counter(), 0
    for items, times in patterns:
        offset = 0
        for length in items:
            rows.append((length, seen[length], first, offset))
            seen[length] += times
            offset += length
        first += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return (table[:, 0] << 44) | table[:, 1], table[:, 1], table[:, 2], table[:, 3]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenized(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every document: its ids and the end id.

    Returns doc_id, piece, start, length, ids_crc32 and, if asked for, ids. A null or
    empty text is the end id alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path, "words")
        for batch in slices(batches, "text"):
            ids, lens = tokens.encode(texts_of(batch))
            ends = np.cumsum(lens + 1)
            flat = np.full(int(ends[-1]), END_ID, np.uint32)
            inside = np.ones(len(flat), bool)
            inside[ends - 1] = False
            flat[inside] = ids
            sizes = lens + 1
            per = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(sizes)), per)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
            start = piece * capacity
            length = np.minimum(capacity, sizes[owner] - start)
            begin = (ends - sizes)[owner] + start
            data = memoryview(flat.astype("<u4")).cast("B")
            crc = [zlib.crc32(data[4 * b : 4 * (b + n)]) for b, n in zip(begin.tolist(), length.tolist(), strict=True)]
            columns = [batch.column(0).take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(flat)), pa.int32()), pa.array(flat.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, PIECES + (", ids array<int>" if keep_ids else ""))


def place(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """Adds sequence_id and offset to pieces of given ``length`` (at least 1, at most ``capacity``).

    Only the number of pieces of each length comes to the driver.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    keys, firsts, sequences, offsets = runs(solve(counts, capacity, nodes))
    schema = pieces.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(batch.num_columns - 1).to_numpy()
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            at = np.searchsorted(keys, (length << 44) | number, side="right") - 1
            own = [pa.array(sequences[at] + number - firsts[at]), pa.array(offsets[at])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *own], [*schema.names, "sequence_id", "offset"])

    out = numbered(pieces, ["length"], ["doc_id", "piece", "start", "ids_crc32"], "_number").select(*schema.names, "_number")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return out.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, nodes: int = NODES, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Packs all documents into as few sequences of at most ``capacity`` tokens as it can find.

    Each document is its ids and an end id. Only a longer one is cut, into pieces of
    ``capacity``. Returns per piece doc_id, piece, start, length, ids_crc32, sequence_id and
    offset (with ``keep_ids`` also ids); the pieces of a sequence lie one after another
    from offset 0. Null and empty texts are packed as one end id each; repeated rows and
    ids are packed once a row; an empty table gives no rows; other columns are not looked
    at. The search starts from the best-fit packing and stops at a proven bound or after
    ``nodes`` nodes; either way every piece is placed.
    """
    pieces = written(tokenized(docs, path, capacity, id_col, text_col, keep_ids), "pieces")
    return place(pieces, capacity, nodes)


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences themselves: sequence_id, ids. Needs ``keep_ids``; one sequence is at most ``capacity`` ids."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
