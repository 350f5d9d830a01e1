"""Token counts by a sentencepiece model, without keeping the tokens."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalframe.llm.words import slices, texts_of

# A text is cut into segments of about this many characters before it is encoded.
SEGMENT_CHARS = 1 << 14
# A single space between two characters that are neither a space nor the model's sign
# for one: the model has no token in which a space follows another character, and it
# puts its sign for a space before every segment itself.
SAFE = re.compile("(?<=[^ ▁]) (?=[^ ▁])")


@lru_cache(maxsize=2)
def load(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    crossing = [p for p in map(model.id_to_piece, range(model.get_piece_size())) if re.search("[^▁]▁", p)]
    if crossing:
        raise ValueError(f"tokens reach across a space in this model: {crossing[:3]}")
    return model


def segments(text: str, size: int = SEGMENT_CHARS) -> list[str]:
    """A text cut at safe boundaries into segments of ``size`` characters or little more."""
    out, start = [], 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.end()
    out.append(text[start:])
    return out


def count_texts(model, texts: list[str]) -> list[int]:
    """Tokens of each text, by one batch of the segments of all."""
    parts, owner = [], []
    for k, text in enumerate(texts):
        for part in segments(text):
            parts.append(part)
            owner.append(k)
    counts = [0] * len(texts)
    for k, ids in zip(owner, model.encode(parts, num_threads=1), strict=True):
        counts[k] += len(ids)
    return counts


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every whole text: doc_id, n_bytes, n_tokens, over_limit (more than ``limit``).

    Each Arrow batch is cut into batches of about equal bytes and long texts into segments
    at safe boundaries, so memory follows the segment, not the text's tokens; only lengths
    leave the function. A null or empty text has 0 bytes and tokens. Null and repeated ids
    keep their rows, an empty table gives none, other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in slices(batches, "text"):
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            counts = pa.array(count_texts(model, texts_of(batch)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, counts], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
