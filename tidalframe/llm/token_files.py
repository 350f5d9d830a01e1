"""Token ids of a corpus in shard files, each of wavelet-matrix blocks.

A shard file is the mark ``WMS1``, blocks of at most ``BLOCK`` tokens, a compressed
directory (document ids and token counts) and a trailer with the place of each part.
Documents lie in ascending order of their id, within a file and from file to file.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidalframe.llm.store import new_file, partitions, read_file, written
from tidalframe.llm.wavelet import WaveletMatrix, block_bytes, block_matrix
from tidalframe.llm.words import encoder, slices, texts_of
from tidalframe.session import scratch

MARK = b"WMS1"
END_ID = 2
# Tokens of a block, and of a shard file, which ends with the document that reaches it.
BLOCK, SHARD = 1 << 20, 1 << 23
# Bytes of text a writing task should get.
TASK_BYTES = 256 << 20

MANIFEST = "part int, seq int, address string, n_docs long, n_tokens long, n_bytes long"


class ShardWriter:
    """Writes one shard file, block by block."""

    def __init__(self, base: str):
        self.out, self.address = new_file(base, ".wms")
        self.out.write(MARK)
        self.at, self.blocks, self.held, self.size = len(MARK), [], [], 0
        self.ids: list[int | None] = []
        self.lens: list[int] = []

    def add(self, ids: list, lens: np.ndarray, tokens: np.ndarray) -> None:
        self.ids += ids
        self.lens += lens.tolist()
        self.held.append(tokens)
        self.size += len(tokens)
        if self.size >= BLOCK:
            every = np.concatenate(self.held)
            for k in range(0, len(every) - len(every) % BLOCK, BLOCK):
                self.put(every[k : k + BLOCK])
            self.held = [every[len(every) - len(every) % BLOCK :]]
            self.size = len(self.held[0])

    def put(self, tokens: np.ndarray) -> None:
        data = block_bytes(tokens)
        self.out.write(data)
        self.blocks.append((self.at, len(data), len(tokens)))
        self.at += len(data)

    def close(self) -> tuple[str, int, int, int]:
        if self.size:
            self.put(np.concatenate(self.held))
        directory = zlib.compress(json.dumps({"ids": self.ids, "lens": self.lens, "blocks": self.blocks}).encode(), 1)
        self.out.write(directory + struct.pack("<QQ", self.at, len(directory)))
        self.out.close()
        return self.address, len(self.ids), sum(self.lens), self.at + len(directory) + 16


class Shard:
    """A shard file read back: tokens by place, counts and occurrences of a token."""

    def __init__(self, data: bytes):
        if data[:4] != MARK:
            raise ValueError("not a shard file")
        at, size = struct.unpack("<QQ", data[-16:])
        self.data, held = memoryview(data), json.loads(zlib.decompress(data[at : at + size]))
        self.ids, self.lens, self.blocks = held["ids"], np.array(held["lens"], np.int64), held["blocks"]
        self.starts = np.cumsum([0, *(n for _, _, n in self.blocks)])

    def block(self, k: int) -> WaveletMatrix:
        at, size, n = self.blocks[k]
        matrix = block_matrix(self.data[at : at + size])
        if matrix.n != n:
            raise ValueError("damaged shard file")
        return matrix

    def access(self, positions) -> np.ndarray:
        positions = np.asarray(positions, np.int64)
        own, out = np.searchsorted(self.starts, positions, side="right") - 1, np.zeros(len(positions), np.int64)
        for k in np.unique(own):
            out[own == k] = self.block(int(k)).access(positions[own == k] - self.starts[k])
        return out

    def count(self, token: int) -> int:
        return sum(self.block(k).count(token) for k in range(len(self.blocks)))

    def occurrences(self, token: int) -> Iterator[int]:
        for k in range(len(self.blocks)):
            matrix = self.block(k)
            for j in range(matrix.count(token)):
                yield int(self.starts[k]) + matrix.select(token, j)

    def documents(self) -> Iterator[tuple[int | None, list[np.ndarray]]]:
        """Each document's id and its tokens, in parts no longer than a block."""
        k, tokens, at = -1, np.zeros(0, np.uint32), 0
        for doc, need in zip(self.ids, self.lens.tolist(), strict=True):
            parts = []
            while need:
                if at == len(tokens):
                    k, at = k + 1, 0
                    tokens = self.block(k).decode()
                take = min(need, len(tokens) - at)
                parts.append(tokens[at : at + take])
                at, need = at + take, need - take
            yield doc, parts


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes all documents' tokens, each followed by the end id; returns the manifest.

    Returns per file part and seq (together its order), address, n_docs, n_tokens, n_bytes.
    Rows are dealt to tasks by ranges of the id, rows of one id by their text, so one id
    may have any share of all rows. Null ids come first. Tasks hold one block at a time.
    """
    spark = docs.sparkSession
    base = scratch(spark, "tokens")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(partitions(docs), -(-total // TASK_BYTES))
    rows = rows.withColumn("_order", F.xxhash64("text")).repartitionByRange(n, "doc_id", "_order").sortWithinPartitions("doc_id", "_order").drop("_order")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, writer, done, part = encoder(path, "spaced"), None, [], TaskContext.get().partitionId()
        filled = 0
        for batch in slices(batches, "text"):
            ids, lens = tokens.encode(texts_of(batch))
            ends = np.cumsum(lens + 1)
            flat = np.full(int(ends[-1]), END_ID, np.uint32)
            inside = np.ones(len(flat), bool)
            inside[ends - 1] = False
            flat[inside] = ids
            writer = writer or ShardWriter(base)
            writer.add(batch.column(0).to_pylist(), lens + 1, flat)
            filled += len(flat)
            if filled >= SHARD:
                done.append(writer.close())
                writer, filled = None, 0
        if writer:
            done.append(writer.close())
        yield pa.RecordBatch.from_pylist([{"part": part, "seq": k, "address": a, "n_docs": d, "n_tokens": t, "n_bytes": b} for k, (a, d, t, b) in enumerate(done)], schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("address", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())]))

    return written(rows.mapInArrow(run, MANIFEST), "manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document of all shard files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it. The files' own starts are a
    running sum over the manifest, which has one row for each file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(read_file(row["address"]))
                if (len(shard.ids), int(shard.lens.sum())) != (row["n_docs"], row["n_tokens"]):
                    raise ValueError(f"{row['address']} does not hold what the manifest says")
                starts = row["first"] + np.cumsum(shard.lens) - shard.lens
                crc = []
                for _, parts in shard.documents():
                    own = 0
                    for x in parts:
                        own = zlib.crc32(x.astype("<u4"), own)
                    crc.append(own)
                yield pa.RecordBatch.from_arrays([pa.array(shard.ids, pa.int64()), pa.array(starts), pa.array(shard.lens), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))
    files = files.repartition(max(1, manifest.count()))
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the shard files of all documents and reads them back, see the two functions above.

    A null or empty text has the end id alone; null ids come first and stay null;
    repeated ids lie side by side; an empty table has no file and no row; other columns
    are not looked at.
    """
    return read_documents(write_shards(docs, path, id_col, text_col))
