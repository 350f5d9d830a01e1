"""Sharding by a k-d tree over document metadata, with DataFrame operations only.

Each node of the tree is cut at a weighted quantile along its widest dimension, all
nodes of a level together: a histogram of bytes by node and bin, a finer one within the
bin the cut lies in, and so on, until a bin weighs little or cannot be divided.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalframe.llm.store import numbered, written

SHARDS = 40
# Bins of a histogram of one node.
BINS = 1024
# Share of a shard's target that a cut may be off by before it is refined further.
SLACK = 1e-4
ROW_BYTES = 16


@dataclass
class Node:
    """shards: from first, count. A cut node sends rows up to (cut, tie) along dim to its left."""

    first: int
    count: int
    dim: int = -1
    cut: int = 0
    tie: int | None = None
    kids: list = field(default_factory=list)


def where(node: Node, dims: list[Column], tie: Column) -> Column:
    """The first shard of the leaf a row belongs to."""
    if not node.kids:
        return F.lit(node.first)
    x, left, right = dims[node.dim], *[where(k, dims, tie) for k in node.kids]
    goes = x <= node.cut if node.tie is None else (x < node.cut) | ((x == node.cut) & (tie <= node.tie))
    return F.when(goes, left).otherwise(right)


@dataclass
class Search:
    """Where one node's cut is sought: keys from low to high, of which ``under`` weighs what lies below."""

    low: int
    high: int
    wanted: float
    dim: int
    at: int | None = None  # the value along dim that rows must have, where they are divided by their number
    under: float = 0.0


def cuts(rows: DataFrame, names: list[str], searches: dict[int, Search], slack: float) -> dict[int, tuple[int, float, float]]:
    """For each node the key at which the weight so far comes nearest to the wanted one.

    Returns (key, weight up to it, weight of the key after it where that key has to be
    divided by another rule, else 0). One histogram is made for all nodes at a time.
    """
    spark, done = rows.sparkSession, {}
    value = F.element_at(F.array(*names), F.col("dim") + 1)
    while open_ := {n: s for n, s in searches.items() if n not in done}:
        step = {n: -(-(s.high - s.low + 1) // BINS) for n, s in open_.items()}
        asked = ", ".join(f"({n}, {s.dim}, {s.low}L, {s.high}L, {step[n]}L, {'CAST(NULL AS LONG)' if s.at is None else f'{s.at}L'})" for n, s in open_.items())
        table = F.broadcast(spark.sql(f"SELECT * FROM VALUES {asked} AS t(node, dim, low, high, step, at)"))
        keyed = rows.join(table, "node").filter(F.col("at").isNull() | (value == F.col("at")))
        keyed = keyed.select("node", "size", "low", "high", "step", F.when(F.col("at").isNull(), value).otherwise(F.col("_tie")).alias("key")).filter("key BETWEEN low AND high")
        counted = keyed.groupBy("node", F.expr("(key - low) DIV step").alias("bin")).agg(F.sum("size").alias("weight"))
        held: dict[int, list] = {n: [] for n in open_}
        for r in counted.collect():  # at most BINS for each of fewer nodes than shards
            held[r["node"]].append((r["bin"], float(r["weight"])))
        for n, s in open_.items():
            run, hit = s.under, None
            for b, weight in sorted(held[n]):
                if run + weight > s.wanted:
                    hit = (b, weight)
                    break
                run += weight
            if hit is None:
                done[n] = (s.high, run, 0.0)
                continue
            start, weight = s.low + hit[0] * step[n], hit[1]
            s.under = run
            if step[n] == 1:
                done[n] = (start - 1, run, weight)
            elif weight <= slack:
                done[n] = (start + step[n] - 1, run + weight, 0.0) if run + weight - s.wanted < s.wanted - run else (start - 1, run, 0.0)
            else:
                s.low, s.high = start, min(s.high, start + step[n] - 1)
    return done


def kd_shards(docs: DataFrame, dims: list[Column], size: Column, carried: list[Column], shards: int = SHARDS) -> DataFrame:
    """Puts all rows into ``shards`` shards of nearly equal bytes: carried columns, size, shard, slot.

    ``dims`` are whole numbers (null counts as -1). The root holds all shards; a node of k
    shards is cut so that its left side, of k // 2, gets that share of the node's bytes, up
    to one row's size. Rows equal along the cut's dimension are divided by a row number
    fixed when the metadata is written, so one value, key or group of copies may have any
    share of all rows. Slots count from 0 without gaps in each shard. An empty table gives
    no rows; fewer rows than shards leave shards empty.
    """
    names = [f"_d{k}" for k in range(len(dims))]
    rows = docs.select(*carried, size.cast("long").alias("size"), *[F.coalesce(d.cast("long"), F.lit(-1)).alias(n) for d, n in zip(dims, names, strict=True)])
    rows = written(rows.withColumn("_tie", F.monotonically_increasing_id()), "metadata")
    tie, columns = F.col("_tie"), [F.col(n) for n in names]
    root = Node(0, shards)
    total = rows.agg(F.sum("size")).first()[0]
    if total is None:
        return rows.select(*[f for f in rows.columns if f not in (*names, "_tie")], F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    slack, spans = SLACK * total / shards, None
    level = [root]
    while level := [n for n in level if n.count > 1]:
        own = rows.withColumn("node", where(root, columns, tie))
        stats = own.groupBy("node").agg(F.sum("size").alias("w"), *[f(c).alias(f"{c}{f.__name__}") for c in (*names, "_tie") for f in (F.min, F.max)])
        stats = {r["node"]: r for r in stats.collect() if r["node"] in {n.first for n in level}}  # one row for each node
        spans = spans or [max(1, stats[0][f"{c}max"] - stats[0][f"{c}min"]) for c in names]
        at = {n.first: n for n in level if n.first in stats}
        for first, n in at.items():
            r = stats[first]
            n.dim = max(range(len(names)), key=lambda d: (r[f"{names[d]}max"] - r[f"{names[d]}min"]) / spans[d])
        wanted = {first: stats[first]["w"] * (n.count // 2) / n.count for first, n in at.items()}
        along = cuts(own, names, {first: Search(stats[first][f"{names[n.dim]}min"], stats[first][f"{names[n.dim]}max"], wanted[first], n.dim) for first, n in at.items()}, slack)
        shared = {first: wanted[first] - under for first, (_, under, after) in along.items() if after > 0}
        ties = cuts(own, names, {first: Search(stats[first]["_tiemin"], stats[first]["_tiemax"], w, at[first].dim, along[first][0] + 1) for first, w in shared.items()}, slack)
        below = []
        for n in level:
            if n.first in at:
                n.cut = along[n.first][0]
                if n.first in ties:
                    cut, under, after = ties[n.first]
                    nearer = after > 0 and under + after - shared[n.first] < shared[n.first] - under
                    n.cut, n.tie = n.cut + 1, cut + 1 if nearer else cut
            half = n.count // 2
            n.kids = [Node(n.first, half), Node(n.first + half, n.count - half)]
            below += n.kids
        level = below
    sharded = rows.withColumn("shard", where(root, columns, tie)).drop(*names)
    return numbered(sharded, ["shard"], ["_tie"], "slot").drop("_tie")


def document_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents by language, source, size and id: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Languages and sources are placed along their dimension by a hash. A null text has no
    bytes and the checksum of none. The law is ``bytes``; grown_shard is null.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.octet_length(text) + ROW_BYTES
    place = lambda c: F.crc32(F.col(c).cast("binary")) if c in docs.columns else F.lit(0)
    dims = [place("lang"), place("source"), size, F.col(id_col)]
    carried = [F.col(id_col).cast("long").alias("doc_id"), F.crc32(text.cast("binary")).alias("text_crc32")]
    out = kd_shards(docs, dims, size, carried, shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
