"""Fill in the middle: documents turned into prefix, suffix and middle by a counted pattern.

A text is a run of units, a word of plain letters or any other character. Two cuts drawn
from a hash of the id part its n units into prefix, middle and suffix. A pattern written
for each row, a possessive repetition of the unit for each part, finds all three in one
match, and its replacement puts them in their new order:

    \\A((?:unit){a}+)((?:unit){b-a}+)(.*)\\z  ->  <P>prefix<S>suffix<M>middle   (psm)
                                              or  <S>suffix<P>prefix<M>middle   (spm)

A possessive repetition is matched in a loop, without going back and without a stack, so
texts of any length are matched whole. Nothing is shuffled.

Nulls, ties and odd input: a null text counts as empty; a null id is drawn for as the
empty string. Empty texts and texts that hold a marker's string stay as they are, so an
output can always be taken apart again. Equal rows give equal results. An empty table
gives no rows; columns of the names used here are replaced, others are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the task: what one unit is, and the markers.
UNIT = "[A-Za-z]+|[^A-Za-z]"
UNIT_ONCE = "(?:[A-Za-z]++|[^A-Za-z])"
MARKERS = "<[PSM]>"


def draws(id: Column, seed: int) -> Column:
    """Four numbers below 2^32 from the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


def infilled(docs: DataFrame, text: str = "text", id: str = "doc_id", seed: int = 1, percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """The rows with n, form, prefix_chars, middle_chars and output.

    form is plain, psm or spm; ``percent`` of the texts are taken apart, ``spm_percent`` of
    those with the suffix first.
    """
    rows = docs.withColumn("_whole", F.coalesce(F.col(text), F.lit(""))).withColumn("_draws", draws(F.col(id), seed))
    rows = rows.withColumn("n", F.regexp_count("_whole", F.lit(UNIT)).cast("long"))
    plain = (F.col("n") == 0) | F.col("_whole").rlike(MARKERS) | (F.col("_draws")[2] % 100 >= percent)
    rows = rows.withColumn("form", F.when(plain, "plain").when(F.col("_draws")[3] % 100 < spm_percent, "spm").otherwise("psm"))
    rows = rows.withColumn("_x", F.col("_draws")[0] % (F.col("n") + 1)).withColumn("_y", F.col("_draws")[1] % (F.col("n") + 1))
    first, second = F.least("_x", "_y"), F.greatest("_x", "_y")
    pattern = F.concat(
        F.lit(rf"(?s)\A({UNIT_ONCE}{{"), first.cast("string"), F.lit(rf"}}+)({UNIT_ONCE}{{"), (second - first).cast("string"), F.lit(r"}+)(.*)\z")
    )
    order = F.when(F.col("form") == "spm", "<S>$3<P>$1<M>$2").otherwise("<P>$1<S>$3<M>$2")
    rows = rows.withColumn("output", F.when(F.col("form") == "plain", F.col("_whole")).otherwise(F.regexp_replace("_whole", pattern, order)))
    rows = rows.withColumn("_parts", parts(F.col("form"), F.col("output")))
    rows = rows.withColumn("prefix_chars", F.char_length("_parts.prefix").cast("long")).withColumn("middle_chars", F.char_length("_parts.middle").cast("long"))
    return rows.drop("_whole", "_draws", "_x", "_y", "_parts")


def parts(form: Column, output: Column) -> Column:
    """(prefix, middle, suffix) of an output, read between its markers; null if it is plain."""
    cut = F.split(output, MARKERS, -1)
    swapped = form == "spm"
    found = F.struct(
        F.when(swapped, cut[2]).otherwise(cut[1]).alias("prefix"), cut[3].alias("middle"), F.when(swapped, cut[1]).otherwise(cut[2]).alias("suffix")
    )
    return F.when(form != "plain", found)


def restored(form: Column, output: Column) -> Column:
    """The exact text again."""
    held = parts(form, output)
    return F.when(form == "plain", output).otherwise(F.concat(held["prefix"], held["middle"], held["suffix"]))


def digest(docs: DataFrame, id: str = "doc_id") -> DataFrame:
    """One row per document: the form, sizes, and checksums of the output and of the text rebuilt from it."""
    found = infilled(docs.select(id, "text"), id=id).withColumn("_restored", restored(F.col("form"), F.col("output")))
    return found.select(
        id, "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("_restored", 256).alias("restored_sha256")
    )
