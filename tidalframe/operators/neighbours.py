"""Imputation by nearest neighbours over all predictors, numbers and categories mixed.

Distance is Gower's: the mean over the predictors of |a - b| / range for a number and of
0 or 1 for a category. The donors lie in the cells of a tree that is grown on a bounded
sample of them; a cell's box (smallest and largest number, set of categories) bounds the
distance of any row from all its donors. A row first looks at the cell it would lie in; its
k-th distance there then says which other cells can still hold a neighbour, and only
those are looked at. Within a cell the same is done with runs of donors that are near one
another, so that a row meets few donors however many a cell holds. So neighbours are exact,
whatever the cells and runs.

Rows of one profile are looked up once, and of the donors of one profile only the k with
the smallest keys can be chosen: the others are dropped from each run of rows that a task
reads, so that a frequent profile does not fill its cell, and again in the search.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidalframe.functions.exact import mean
from tidalframe.operators.joins import by_group
from tidalframe.session import cut_lineage

# Donors the tree is grown on at most, and cells of it at most; donors a cell should hold.
SAMPLE, CELLS, CELL_ROWS = 50_000, 1024, 2048
# Donors of a leaf of a cell's own tree, about.
LEAF_ROWS = 64
# Rows that are searched together in a cell.
GROUP_ROWS = 32
# Rows whose distances from a cell's donors are computed at once.
BLOCK = 2_000_000
# Rows of one cell that are searched in one task.
PART_ROWS = 50_000
# Donors among which a task looks for rows of one profile.
RUN_ROWS = 100_000
SLACK = 1e-9


@dataclass
class Tree:
    """Splits: feature, -1 at the end of a branch, and cut; values and codes up to the cut go left."""

    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    cell: list[int] = field(default_factory=list)

    def add(self) -> int:
        for held, value in ((self.feature, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1), (self.cell, -1)):
            held.append(value)
        return len(self.feature) - 1

    def place(self, x: np.ndarray) -> np.ndarray:
        """The cell of each row."""
        feature, cut, left, right, cell = (np.array(v) for v in (self.feature, self.cut, self.left, self.right, self.cell))
        at = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(feature[at] >= 0)
            if not len(inner):
                return cell[at]
            goes = x[inner, feature[at[inner]]] <= cut[at[inner]]
            at[inner] = np.where(goes, left[at[inner]], right[at[inner]])


def grown(x: np.ndarray, n_numbers: int, reach: np.ndarray, cells: int) -> Tree:
    """A tree of at most ``cells`` leaves: the largest leaf is split next, where that parts rows farthest.

    A row on one side of a number's cut lies a quarter of the range from the other side on
    average; a row of one half of the levels lies a whole step from the other half.
    """
    tree, ready = Tree(), []
    root = tree.add()
    heapq.heappush(ready, (-len(x), root, np.arange(len(x))))
    leaves = 1
    done: list[int] = []
    while ready:
        _, node, rows = heapq.heappop(ready)
        best = (0.0, -1, 0.0)
        for f in range(x.shape[1]) if leaves < cells else ():
            v = np.sort(x[rows, f])
            if v[0] == v[-1] or f < n_numbers and not reach[f] > 0:
                continue
            # The cut between different values that is nearest to the middle.
            middle = v[(len(v) - 1) // 2]
            after = int(np.searchsorted(v, middle, side="right"))
            before = int(np.searchsorted(v, middle, side="left"))
            after = after if before == 0 or after < len(v) and after - len(v) / 2 <= len(v) / 2 - before else before
            share = after / len(v)
            low, high = v[len(v) // 20], v[-1 - len(v) // 20]
            gain = (high - low) / reach[f] / 4 if f < n_numbers and high > low else 2 * share * (1 - share) * (1.0 if f >= n_numbers else 1e-3)
            if gain > best[0]:
                best = (float(gain), f, float(v[after - 1]))
        if best[1] < 0:
            done.append(node)
            continue
        goes = x[rows, best[1]] <= best[2]
        tree.feature[node], tree.cut[node] = best[1], best[2]
        for side, mine in (("left", goes), ("right", ~goes)):
            child = tree.add()
            getattr(tree, side)[node] = child
            heapq.heappush(ready, (-int(mine.sum()), child, rows[mine]))
        leaves += 1
    for k, node in enumerate(done):
        tree.cell[node] = k
    return tree


def halved(x: np.ndarray, n_numbers: int, size: int) -> np.ndarray:
    """Runs of about ``size`` rows that are near one another (runs x rows), by halving along the widest column.

    What is missing to full runs is filled with numbers from ``len(x)`` on, which are rows 0, 1, ... again.
    """
    levels = max(0, int(np.ceil(np.log2(max(1, len(x)) / size))))
    runs = 2**levels
    order = np.arange(runs * -(-len(x) // runs))
    held = x[order % len(x)]
    for level in range(levels):
        nodes = order.reshape(2**level, -1)
        v = held[nodes]
        spread = v.max(1) - v.min(1)
        spread[:, n_numbers:] = 2 * (spread[:, n_numbers:] > 0)
        by = np.take_along_axis(v, spread.argmax(1)[:, None, None], 2)[:, :, 0]
        order = np.take_along_axis(nodes, np.argpartition(by, nodes.shape[1] // 2, axis=1), 1).ravel()
    return order.reshape(runs, -1)


def nearest(x: np.ndarray, far: np.ndarray, donors: np.ndarray, n_numbers: int, reach: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, donor, distance): for each row the k nearest donors, the earlier first at one distance, none beyond ``far``.

    Rows that are near one another go together: they meet the runs of donors in order of
    their least distance until the next run is farther than the k-th donor of each. Single
    precision says which donors may be among the k; their distances are then computed in
    full. Where a number is not finite, all are compared.
    """
    asked = [f for f in range(n_numbers) if reach[f] > 0]
    if not (np.isfinite(x[:, asked]).all() and np.isfinite(donors[:, asked]).all() and np.isfinite(reach[asked]).all()):
        rows, step = [], max(1, BLOCK // len(donors))
        for at in range(0, len(x), step):
            d = distances(x[at : at + step], donors, n_numbers, reach)
            own = np.argsort(d, axis=1, kind="stable")[:, :k]
            rows.append((at + np.repeat(np.arange(len(d)), own.shape[1]), own.ravel(), np.take_along_axis(d, own, 1).ravel()))
        return tuple(np.concatenate(c) for c in zip(*rows, strict=True))
    width, m = x.shape[1], len(asked)
    # Numbers as shares of their ranges, then each category's levels numbered.
    both = np.concatenate([donors, x])
    columns = [(both[:, f] - donors[:, f].min()) / reach[f] for f in asked]
    slack = 2.0**-20 * width**2 * max([1.0, *(float(np.abs(c).max()) for c in columns)])
    columns += [np.unique(both[:, f], return_inverse=True)[1] for f in range(n_numbers, width)]
    scaled = np.stack(columns, 1).astype(np.float32) if columns else np.zeros((len(both), 0), np.float32)
    if not columns or not len(x):
        scaled, m = np.zeros((len(both), 1), np.float32), 1
    given, own = scaled[: len(donors)], scaled[len(donors) :]
    runs = halved(given, m, LEAF_ROWS)
    lanes = np.ascontiguousarray(given[runs % len(donors)].transpose(2, 0, 1))
    low, high = lanes.min(2), lanes.max(2)
    groups = halved(own, m, GROUP_ROWS) if len(x) else np.zeros((0, 1), np.int64)
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for group in groups:
        rows = group[group < len(x)]
        if not len(rows):
            continue
        q = own[rows]
        q_low, q_high = q.min(0)[:, None], q.max(0)[:, None]
        apart = np.maximum(low - q_high, q_low - high)
        least = np.maximum(apart[:m], 0).sum(0, dtype=np.float64) + (apart[m:] > 0).sum(0)
        turn = np.argsort(least, kind="stable")
        least = least[turn]
        limit = far[rows] * width + slack
        best = np.full((len(rows), k), np.inf, np.float32)
        found, at, take = [], 0, 2 + k // LEAF_ROWS
        while at < len(turn):
            stop = min(at + take, int(np.searchsorted(least, limit.max() + slack, side="right")), at + max(1, BLOCK // (len(rows) * runs.shape[1])))
            if stop <= at:
                break
            chosen = turn[at:stop]
            names = runs[chosen].ravel()
            d = screened(q, lanes[:, chosen].reshape(len(lanes), -1), m)
            d[:, names >= len(donors)] = np.inf
            best = np.partition(np.concatenate([best, d], 1), k - 1, axis=1)[:, :k]
            limit = np.minimum(limit, best.max(1).astype(float) + 2 * slack)
            row, column = np.nonzero(d <= limit[:, None])
            found.append((row, names[column], d[row, column]))
            at, take = stop, 2 * take
        if not found:
            continue
        row, donor, d = (np.concatenate(c) for c in zip(*found, strict=True))
        left = d <= limit[row]
        row, donor = row[left], donor[left]
        exact = paired(x[rows[row]], donors[donor], n_numbers, reach)
        row, donor, exact = (c[exact <= far[rows[row]]] for c in (row, donor, exact))
        turn = np.lexsort((donor, exact, row))
        row, donor, exact = row[turn], donor[turn], exact[turn]
        first = np.arange(len(row)) - np.searchsorted(row, row, side="left") < k
        out.append((rows[row[first]], donor[first], exact[first]))
    row, donor, d = (np.concatenate(c) for c in zip(*out, strict=True))
    turn = np.argsort(row, kind="stable")
    return row[turn], donor[turn], d[turn]


def screened(q: np.ndarray, lanes: np.ndarray, m: int) -> np.ndarray:
    """Sums of the distances of rows and donors in single precision; ``lanes`` has a line for each predictor, numbers first."""
    total = np.zeros((len(q), lanes.shape[1]), np.float32)
    one = np.empty_like(total)
    for f in range(len(lanes)):
        if f < m:
            np.subtract(q[:, f, None], lanes[None, f], out=one)
            np.abs(one, out=one)
            total += one
        elif (q[:, f] == q[0, f]).all():
            total += lanes[None, f] != q[0, f]
        else:
            total += lanes[None, f] != q[:, f, None]
    return total


def paired(x: np.ndarray, donors: np.ndarray, n_numbers: int, reach: np.ndarray) -> np.ndarray:
    """As ``distances``, of each row and the donor beside it."""
    total = np.zeros(len(x))
    for f in range(x.shape[1]):
        if f < n_numbers:
            if reach[f] > 0:
                total += np.abs(x[:, f] - donors[:, f]) / reach[f]
        else:
            total += x[:, f] != donors[:, f]
    return total / x.shape[1]


def bounds(x: np.ndarray, low: np.ndarray, high: np.ndarray, seen: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Least distance of each row from any donor of each cell (rows x cells).

    ``seen`` has a bit for each residue of the category codes that occur in a cell.
    """
    n_numbers = low.shape[1]
    total = np.zeros((len(x), len(low)))
    for f in range(n_numbers):
        if reach[f] > 0:
            v = x[:, f, None]
            total += np.maximum(0, np.maximum(low[None, :, f] - v, v - high[None, :, f])) / reach[f]
    for f in range(x.shape[1] - n_numbers):
        bit = np.uint64(1) << (x[:, n_numbers + f].astype(np.int64) % 64).astype(np.uint64)
        total += (seen[None, :, f] & bit[:, None]) == 0
    return total / x.shape[1]


def distances(x: np.ndarray, donors: np.ndarray, n_numbers: int, reach: np.ndarray) -> np.ndarray:
    """Gower distances of rows and donors, added up in the order of the predictors."""
    total = np.zeros((len(x), len(donors)))
    for f in range(x.shape[1]):
        if f < n_numbers:
            if reach[f] > 0:
                total += np.abs(x[:, f, None] - donors[None, :, f]) / reach[f]
        else:
            total += x[:, f, None] != donors[None, :, f]
    return total / x.shape[1]


@dataclass(frozen=True)
class Neighbours:
    """Donors of one target, ready to be searched: see ``fit``."""

    target: str
    key: str
    numbers: tuple[str, ...]
    categories: tuple[str, ...]
    k: int
    donors: DataFrame
    means: tuple[float, ...]
    reach: tuple[float, ...]
    tree: Tree
    boxes: tuple[np.ndarray, np.ndarray, np.ndarray]

    @property
    def width(self) -> int:
        return len(self.numbers) + len(self.categories)


def profile(df: DataFrame, numbers: Sequence[str], categories: Sequence[str], means: Sequence[float]) -> DataFrame:
    """Adds ``_x``: numbers (a missing one counts as the mean) and codes of the categories (a missing one is a level).

    A code is a hash of 52 bits, so that a double holds it. ``_h`` is a hash of the whole, quick to sort by.
    """
    values = [F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in zip(numbers, means, strict=True)]
    code = lambda c: F.shiftrightunsigned(F.xxhash64(F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))), 12)
    return df.withColumn("_x", F.array(*values, *[code(c).cast("double") for c in categories])).withColumn("_h", F.xxhash64("_x"))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    held = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return held.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of at least so many rows, the last one apart."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def firsts(x: np.ndarray, keys: pa.ChunkedArray, k: int) -> np.ndarray:
    """The rows in the order of their keys, without those that k rows of the same profile precede.

    Rows of two profiles with one hash may all be left.
    """
    turn = pc.sort_indices(pa.table({"key": keys}), sort_keys=[("key", "ascending")], null_placement="at_start").to_numpy()
    bits = np.ascontiguousarray(x[turn]).view(np.uint64).reshape(x.shape)
    mixed = np.zeros(len(x), np.uint64)
    for f in range(x.shape[1]):
        mixed = (mixed ^ bits[:, f] ^ (bits[:, f] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    order = np.argsort(mixed, kind="stable")
    new = np.ones(len(x), bool)
    new[1:] = (bits[order[1:]] != bits[order[:-1]]).any(1)
    at = np.arange(len(x))
    return turn[np.sort(order[at - np.maximum.accumulate(np.where(new, at, 0)) < k])]


def fit(train: DataFrame, key: str, target: str, numbers: Sequence[str], categories: Sequence[str], k: int = 5, cells: int = CELLS, sample: int = SAMPLE) -> Neighbours:
    """Donors are the training rows that know the target; keys tell donors at one distance apart, the smaller first.

    Means and ranges of the numbers come from all training rows. A predictor of one value
    adds nothing to any distance.
    """
    numbers, categories = tuple(c for c in numbers if c != target), tuple(c for c in categories if c != target)
    width = len(numbers) + len(categories)
    known, whole = F.col(target).isNotNull(), F.xxhash64(F.lit(0), *numbers, *categories)
    facts = train.agg(*[F.avg(F.col(c).cast("double")) for c in numbers], *[(F.max(c) - F.min(c)).cast("double") for c in numbers], F.approx_count_distinct(F.when(known, whole))).first()
    means = tuple(float(v or 0.0) for v in facts[: len(numbers)])
    reach = tuple(float(v or 0.0) for v in facts[len(numbers) : 2 * len(numbers)])
    donors = profile(train.where(known), numbers, categories, means).select(F.col(key).alias("_key"), F.col(target).alias("_value"), "_x")
    n = facts[-1]  # profiles, about
    some = train.where(known & (F.pmod(whole, F.lit(1_000_000)) < F.lit(int(1_000_000 * min(1.0, sample / max(n, 1))) + 1)))
    drawn = profile(some, numbers, categories, means).select("_x").distinct().limit(2 * sample).toArrow()
    x = matrix(drawn.column("_x"), width) if drawn.num_rows else np.zeros((0, width))
    tree = grown(x, len(numbers), np.array(reach), max(1, min(cells, n // CELL_ROWS))) if len(x) else grown(np.zeros((1, width)), len(numbers), np.array(reach), 1)
    n_numbers = len(numbers)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in gathered(batches, RUN_ROWS):
            x = matrix(run.column("_x"), width)
            left = firsts(x, run.column("_key"), k)
            cell = tree.place(x[left])
            yield from run.take(pa.array(left)).append_column("_cell", pa.array(cell.astype(np.int32))).to_batches(max_chunksize=10_000)

    placed = cut_lineage(donors.mapInArrow(place, T.StructType([*donors.schema.fields, T.StructField("_cell", T.IntegerType())])))
    at = lambda f: F.col("_x")[f]
    box = placed.groupBy("_cell").agg(
        F.array(*[F.min(at(f)) for f in range(n_numbers)], F.lit(0.0)).alias("low"),
        F.array(*[F.max(at(f)) for f in range(n_numbers)], F.lit(0.0)).alias("high"),
        F.array(*[F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(cast(_x[{n_numbers + f}] as bigint), 64) as int))")) for f in range(len(categories))], F.lit(0).cast("long")).alias("seen"),
    )
    held = sorted(box.collect(), key=lambda r: r["_cell"])  # at most ``cells`` rows
    names = np.array([r["_cell"] for r in held], np.int64)
    table = lambda c, kind, m: np.array([r[c][:m] for r in held], kind).reshape(len(held), m)
    boxes = (table("low", float, n_numbers), table("high", float, n_numbers), table("seen", np.int64, len(categories)).view(np.uint64))
    return Neighbours(target, key, numbers, categories, k, placed, means, reach, tree, (names, *boxes))


def open_cells(x: np.ndarray, far: np.ndarray, low: np.ndarray, high: np.ndarray, seen: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell): the cells that may hold a donor within ``far`` of each row.

    Cells too far from the box of all the rows are left out first.
    """
    n_numbers, asked = low.shape[1], reach > 0
    bits = np.bitwise_or.reduce(np.uint64(1) << (x[:, n_numbers:].astype(np.int64) % 64).astype(np.uint64), axis=0)
    apart = np.maximum(0, np.maximum(low - x[:, :n_numbers].max(0), x[:, :n_numbers].min(0) - high))[:, asked] / reach[asked]
    least = (apart.sum(1) + ((seen & bits) == 0).sum(1)) / x.shape[1]
    cells = np.flatnonzero(~(least > far.max() + SLACK))
    rows, step = [], max(1, BLOCK // max(1, len(cells)))
    for at in range(0, len(x), step):
        part = bounds(x[at : at + step], low[cells], high[cells], seen[cells], reach) <= far[at : at + step, None] + SLACK
        row, cell = np.nonzero(part)
        rows.append((at + row, cells[cell]))
    return tuple(np.concatenate(c) for c in zip(*rows, strict=True))


def ranked(model: Neighbours, df: DataFrame, k: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(_id, nth, value): the k nearest donors' values, nearest first, of each distinct profile of ``df``; (_id, _h, _x): the profiles."""
    k, width, n_numbers, reach, tree = k or model.k, model.width, len(model.numbers), np.array(model.reach), model.tree
    names, low, high, seen = model.boxes
    asked = profile(df, model.numbers, model.categories, model.means).select("_h", "_x").distinct().withColumn("_id", F.monotonically_increasing_id())
    value = model.donors.schema["_value"]
    if not len(names):
        asked = cut_lineage(asked)
        return asked.select("_id", F.lit(0).alias("nth"), F.lit(None).cast(value.dataType).alias("value")).limit(0), asked

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = tree.place(matrix(batch.column("_x"), width))
            yield batch.append_column("_cell", pa.array(np.where(np.isin(cell, names), cell, names[0]).astype(np.int32)))

    asked = cut_lineage(asked.mapInArrow(place, T.StructType([*asked.schema.fields, T.StructField("_cell", T.IntegerType())])))
    nullable = lambda name, kind: T.StructField(name, kind, True)
    found_schema = T.StructType(
        [nullable("_id", T.LongType()), nullable("_x", T.ArrayType(T.DoubleType())), nullable("_cell", T.IntegerType()), nullable("_far", T.DoubleType()), nullable("_distance", T.DoubleType())]
        + [nullable("_key", model.donors.schema["_key"].dataType), nullable("_value", value.dataType)]
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        """Neighbours in this cell and, where no limit was given, the other cells to look at with the limit from this one."""
        own = matrix(right.column("_x"), width)
        order = firsts(own, right.column("_key"), k)
        donors, own = right.select(["_key", "_value"]).take(pa.array(order)), own[order]
        ids, cells = left.column("_id").to_numpy(), left.column("_cell").to_numpy()
        x, given = matrix(left.column("_x"), width), left.column("_far").to_numpy() if "_far" in left.column_names else None
        kinds = {"_x": pa.list_(pa.float64()), "_cell": pa.int32(), "_far": pa.float64(), "_distance": pa.float64(), "_key": donors.schema.field("_key").type, "_value": donors.schema.field("_value").type}

        def made(n: int, **columns) -> pa.Table:
            return pa.table({c: columns.get(c, pa.nulls(n, kinds.get(c))) for c in found_schema.names})

        if not len(own) or not len(x):
            return made(0, _id=pa.array([], pa.int64()))
        # Donors are in the order of their keys: the earlier of two at one distance has the smaller key.
        row, donor, d = nearest(x, np.full(len(x), np.inf) if given is None else given, own, n_numbers, reach, k)
        taken = donors.take(pa.array(donor))
        out = [made(len(row), _id=pa.array(ids[row]), _distance=pa.array(d), _key=taken.column("_key").combine_chunks(), _value=taken.column("_value").combine_chunks())]
        if given is None:
            far = np.full(len(x), -np.inf)
            np.maximum.at(far, row, d)
            far[np.bincount(row, minlength=len(x)) < k] = np.inf
            row, cell = open_cells(x, far, low, high, seen, reach)
            other = names[cell] != cells[row]
            row, cell = row[other], names[cell[other]].astype(np.int32)
            out.append(made(len(row), _id=pa.array(ids[row]), _x=left.column("_x").combine_chunks().take(pa.array(row)).cast(kinds["_x"]), _cell=pa.array(cell), _far=pa.array(far[row])))
        return pa.concat_tables(out)

    def met(rows: DataFrame) -> DataFrame:
        """Rows and donors of each cell, the rows of a cell in parts that fit a task."""
        parts = rows.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias("_parts"))
        parts = F.broadcast(cut_lineage(parts))  # at most one row a cell
        own = rows.join(parts, "_cell").withColumn("_part", F.pmod(F.xxhash64("_id"), F.col("_parts")).cast("int")).drop("_parts")
        given = model.donors.join(parts, "_cell").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
        return own.groupBy("_cell", "_part").cogroup(given.groupBy("_cell", "_part")).applyInArrow(search, found_schema)

    once = cut_lineage(met(asked.drop("_h")))
    more = met(once.where(F.col("_cell").isNotNull()).select("_id", "_x", "_cell", "_far"))
    near = once.where(F.col("_cell").isNull()).unionByName(more).select("_id", "_distance", "_key", "_value")
    order = Window.partitionBy("_id").orderBy("_distance", "_key")
    nth = near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)
    return nth.select("_id", "nth", F.col("_value").alias("value")), asked.select("_id", "_h", "_x")


def filling(kind: T.DataType, scale: int | None) -> Column:
    """The mean of the neighbours' numbers, or the most frequent of their levels, the smallest of several."""
    if isinstance(kind, T.NumericType):
        return mean("value", scale)
    return F.mode("value", True)


def with_filled(model: Neighbours, df: DataFrame, out: str, k: int | None = None, scale: int | None = None) -> DataFrame:
    """The rows of ``df`` with a column ``out``: the target, or what the neighbours say where it is missing."""
    return with_several(model, df, {out: k or model.k}, scale)


def with_several(model: Neighbours, df: DataFrame, ks: dict[str, int], scale: int | None = None) -> DataFrame:
    """As ``with_filled``, with a column for each number of neighbours, named by the keys; one search finds them all.

    Of the donors of a profile as many are looked at as the largest number asks for, so a
    smaller one has the first of them.
    """
    numeric = isinstance(df.schema[model.target].dataType, T.NumericType)
    wanted = df.where(F.col(model.target).isNull())
    found, asked = ranked(model, wanted, max(ks.values()))
    kept = [F.when(F.col("nth") <= k, F.col("value")).alias(f"_k{k}") for k in dict.fromkeys(ks.values())]
    ways = {k: mean(f"_k{k}", scale) if numeric else F.mode(f"_k{k}", True) for k in ks.values()}
    filled = asked.select("_id", "_x").join(found.select("_id", *kept).groupBy("_id").agg(*[w.alias(f"_filled{k}") for k, w in ways.items()]), "_id").drop("_id")
    rows = by_group(profile(wanted, model.numbers, model.categories, model.means), filled, ["_x"], "left")
    own = F.col(model.target).cast("double") if numeric else F.col(model.target)
    known = df.where(F.col(model.target).isNotNull()).select(*df.columns, *[own.alias(name) for name in ks])
    return known.unionByName(rows.select(*df.columns, *[F.col(f"_filled{k}").alias(name) for name, k in ks.items()]))


def impute(models: Sequence[Neighbours], df: DataFrame, k: int | None = None, scale: int | None = None) -> DataFrame:
    """The rows of ``df`` with the missing values of all models' targets filled.

    Numbers are filled by the mean of the neighbours (and become doubles), levels by the
    most frequent one, the smallest of several. Each target is filled from the predictors
    as they were given, not as another model filled them. Without donors it stays null.
    """
    out, names = df, {m.target: f"_filled_{i}" for i, m in enumerate(models)}
    for model in models:
        out = with_filled(model, out, names[model.target], k, scale)
    return out.select(*[F.col(names.get(c, c)).alias(c) for c in df.columns])


def tune(train: DataFrame, key: str, target: str, numbers: Sequence[str], categories: Sequence[str], ks: Sequence[int], folds: int) -> DataFrame:
    """(k, fold, n, rmse) of filling known targets of each fold from the other folds.

    ``train`` has a ``fold`` column. One search for the largest k of each fold serves all.
    """
    most, out = max(ks), None
    for i in range(folds):
        model = fit(train.where(F.col("fold") != i), key, target, numbers, categories, most)
        held = train.where((F.col("fold") == i) & F.col(target).isNotNull())
        near, asked = ranked(model, held, most)
        sums = [F.avg(F.when(F.col("nth") <= k, F.col("value").cast("double"))).alias(f"_k{k}") for k in ks]
        guessed = profile(held, model.numbers, model.categories, model.means).join(asked.join(near.groupBy("_id").agg(*sums), "_id"), ["_h", "_x"])
        long = guessed.select(F.col(target).cast("double").alias("_t"), F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"_k{k}").alias("_e")) for k in ks])))
        scored = long.groupBy("k").agg(F.count("_e").alias("n"), F.sqrt(F.avg((F.col("_t") - F.col("_e")) ** 2)).alias("rmse"))
        part = scored.select("k", F.lit(i).alias("fold"), "n", "rmse")
        out = part if out is None else out.unionByName(part)
    return out


def best_k(tuned: DataFrame) -> int:
    """The k with the smallest mean error over the folds, the smallest of several."""
    return tuned.groupBy("k").agg(F.avg("rmse").alias("rmse")).orderBy("rmse", "k").first()["k"]
