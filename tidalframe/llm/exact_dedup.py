"""Exact duplicates: grouped by a 128-bit hash of the content, compared byte by byte.

A row's content is its text without white space of `[\\x20\\x09-\\x0D]`. Rows of equal
content are a group; the one with the most code points in its own text stays, then the
one with the smallest id, then the one that was read first.

Each group is reduced to one row inside the map tasks before anything is shuffled. The
groups of more than a quarter of a partition's share, of which there can be only a few
for each partition, meet their rows by broadcast; all other groups are small and meet
them by a shuffle. So no task ever holds a large group.

Nulls, ties and odd input: a null text counts as empty, and all empty texts and texts of
white space are one group. A null id is larger than any other. Rows alike in id and
length are told apart by the order of reading, so that exactly one row of a group stays.
Very long texts are only hashed and compared, never split or cut. An empty table gives no
rows. Columns of any other name are ignored unless ``carried``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalframe.llm.store import met, written

BLANKS = " \t\n\x0b\x0c\r"


def content(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def hashed(text: Column) -> Column:
    """128 bits of the content, as 16 bytes."""
    return F.unhex(F.md5(text))


def collisions(rows: DataFrame) -> DataFrame:
    """(_hash, _content, _variant) of the hashes that stand for several contents.

    Grouping by hash and content compares the bytes, already in the map tasks, so that a
    hot content crosses the network once a task.
    """
    different = rows.groupBy("_hash", "_content").agg(F.count(F.lit(1)).alias("_n"))
    several = different.groupBy("_hash").agg(F.count(F.lit(1)).alias("_different")).filter("_different > 1").select("_hash")
    return written(several, "collided_hashes")


def exact_duplicates(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    carried: tuple[str, ...] = (),
    hash: Callable[[Column], Column] = hashed,
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row, with the columns ``carried`` as _c_name."""
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"), *[F.col(c).alias(f"_c_{c}") for c in carried])
    rows = rows.withColumn("_content", content(F.col("_text")))
    rows = rows.withColumn("_hash", hash(F.col("_content")))
    extra = [f"_c_{c}" for c in carried]
    facts = ["_id", F.char_length(F.coalesce("_text", F.lit(""))).alias("_chars"), F.sha2("_content", 256).alias("text_sha256"), F.monotonically_increasing_id().alias("_row")]
    collided = collisions(rows)
    if collided.isEmpty():
        members = rows.select(F.col("_hash").alias("_key"), *facts, *extra)
    else:
        # A hash of several contents: its rows are grouped by the bytes themselves.
        apart = rows.join(collided.withColumn("_apart", F.lit(True)), "_hash", "left")
        members = apart.select(F.when(F.col("_apart"), F.concat(F.col("_hash"), F.lit(b"\0"), F.col("_content").cast("binary"))).otherwise(F.col("_hash")).alias("_key"), *facts, *extra)
    members = written(members, "contents")
    order = F.struct((-F.col("_chars")).alias("chars"), F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    groups = members.groupBy("_key").agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")
    groups = written(groups.select("_key", F.col("_first.id").alias("keep_id"), F.col("_first.row").alias("_keep_row"), "group_size"), "groups_of_equals")
    found = met(members, groups, "_key", "group_size", "left")
    single = F.col("group_size").isNull()
    return found.select(
        F.col("_id").alias(id),
        F.when(single, F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("_keep_row") == F.col("_row"))).alias("kept"),
        "text_sha256",
        *extra,
    )


def deduplicated(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns."""
    found = exact_duplicates(docs, text, id, tuple(c for c in docs.columns if c != id)).filter("kept")
    return found.select(*[F.col(id) if c == id else F.col(f"_c_{c}").alias(c) for c in docs.columns])
