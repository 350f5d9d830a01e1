"""Web archives of zstandard frames: one frame for each record, the dictionary in front.

An archive file starts with a skippable frame that holds the compression dictionary
(itself compressed or not, either is read). Every record after it is a frame of its own,
so that a reader can start at any of them.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalframe.llm.store import new_file, read_file, written
from tidalframe.llm.words import slices
from tidalframe.session import scratch

# Fixed values of the formats: magic numbers of a dictionary's skippable frame, of a
# frame and of a trained dictionary; the revisit profile.
SKIPPABLE, FRAME, TRAINED = 0x184D2A5D, b"\x28\xb5\x2f\xfd", b"\x37\xa4\x30\xec"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Payloads below this many bytes are always stored.
LEAST_BYTES = 100
DICTIONARY_BYTES, SAMPLE_BYTES = 1 << 14, 1 << 20
# An archive ends with the record that reaches this size.
ARCHIVE_BYTES = 64 << 20
DATE = "2000-01-01T00:00:00Z"
FIELD = re.compile(rb"([!#-'*+.0-9A-Z^-z|~-]+):[ \t]*([^\r\n]*)")


class WarcError(ValueError):
    """A record or archive that breaks the format."""


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def clean(value: str) -> str:
    """A header value without control characters, which are written in percent form."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record with its payload, or a revisit record without."""
    revisit = refers_to is not None
    http = b"" if revisit else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = b"" if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}"]
    head += [f"WARC-Target-URI: {clean(url)}"] if url else []
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    head += [f"X-Page-Id: {page_id}"] if page_id is not None else []
    head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}"] if revisit else []
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def fields(head: bytes) -> dict[str, str]:
    """Header lines as a mapping from lower-case names."""
    out = {}
    for line in head.split(b"\r\n"):
        m = FIELD.fullmatch(line)
        if not m:
            raise WarcError(f"bad header line {line[:60]!r}")
        out[m[1].decode().lower()] = m[2].decode()
    return out


def number(held: dict[str, str], name: str) -> int:
    if not re.fullmatch(r"-?\d+", held.get(name, "")):
        raise WarcError(f"{name} is missing or no number")
    return int(held[name])


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of one record, after checks of version, fields, lengths and digest."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not gap or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise WarcError("no record header")
    held = fields(lines)
    for name in ("warc-type", "warc-record-id", "warc-date"):
        if not held.get(name):
            raise WarcError(f"{name} is missing")
    length = number(held, "content-length")
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise WarcError("the block's length is not as stated")
    payload = rest[:length]
    if held["warc-type"] == "response":
        http, gap, payload = payload.partition(b"\r\n\r\n")
        if not gap or not http.startswith(b"HTTP/"):
            raise WarcError("no response header")
        if number(fields(http.partition(b"\r\n")[2]), "content-length") != len(payload):
            raise WarcError("the payload's length is not as stated")
        kind, _, digest = held.get("warc-payload-digest", "").partition(":")
        if kind == "sha256" and hashlib.sha256(payload).hexdigest() != digest:
            raise WarcError("the payload's digest is not as stated")
        if number(held, "x-payload-length") != len(payload):
            raise WarcError("the payload's length is not as stated")
    elif held["warc-type"] == "revisit" and "warc-refers-to" not in held:
        raise WarcError("warc-refers-to is missing")
    return held, payload


def train(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary from sample records, of their plain text where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8)
    except zstandard.ZstdError:
        plain = b"".join(samples)[:DICTIONARY_BYTES]
        return zstandard.ZstdCompressionDict(plain, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """Writes one archive. The first records are held back until the dictionary is trained on them."""

    def __init__(self, base: str):
        self.base, self.out, self.waiting, self.held, self.size, self.n = base, None, [], 0, 0, 0

    def add(self, data: bytes) -> None:
        self.n += 1
        if self.out:
            self.put(data)
            return
        self.waiting.append(data)
        self.held += len(data)
        if self.held >= SAMPLE_BYTES:
            self.open()

    def open(self) -> None:
        self.out, self.address = new_file(self.base, ".warc.zst")
        dictionary = train(self.waiting)
        plain = dictionary.as_bytes()
        packed = zstandard.ZstdCompressor(level=19).compress(plain)
        self.write(struct.pack("<II", SKIPPABLE, len(packed)) + packed)
        self.squeeze = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
        for data in self.waiting:
            self.put(data)
        self.waiting = []

    def put(self, data: bytes) -> None:
        self.write(self.squeeze.compress(data))

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> dict:
        if not self.out:
            self.open()
        self.out.close()
        return {"address": self.address, "n_records": self.n, "n_bytes": self.size}


def dictionary(data: memoryview) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """(dictionary, where the first record begins) of an archive."""
    if len(data) < 8:
        raise WarcError("no archive")
    magic, size = struct.unpack_from("<II", data, 0)
    if magic != SKIPPABLE:
        if bytes(data[:4]) != FRAME:
            raise WarcError("neither a dictionary nor a record in front")
        return None, 0
    if 8 + size > len(data):
        raise WarcError("the dictionary is cut off")
    held = bytes(data[8 : 8 + size])
    if held[:4] == FRAME:
        held = zstandard.ZstdDecompressor().decompress(held)
    kind = zstandard.DICT_TYPE_FULLDICT if held[:4] == TRAINED else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(held, dict_type=kind), 8 + size


def records(data: bytes, step: int = 1 << 14) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of an archive, each decoded from its own frame and checked."""
    view = memoryview(data)
    words, at = dictionary(view)
    reader = zstandard.ZstdDecompressor(dict_data=words) if words else zstandard.ZstdDecompressor()
    while at < len(view):
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            if at >= len(view):
                raise WarcError("the last frame is cut off")
            piece = view[at : at + step]
            try:
                parts.append(frame.decompress(piece))
            except zstandard.ZstdError as err:
                raise WarcError(f"damaged frame: {err}") from err
            at += len(piece)
        at -= len(frame.unused_data)
        yield parse(b"".join(parts))


MANIFEST = "address string, n_records long, n_bytes long"


def decide(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """Pages with their digest and, for repeats of a payload, the page they refer to.

    Only payloads of ``least`` bytes or more that occur under several ids are looked up;
    where these are few, Spark sends them to the pages rather than the pages to them.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"))
    same = rows.filter(F.octet_length("html") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    same = same.filter("n > 1 and first is not null").select(F.col("digest").alias("same"), "first")
    joined = rows.join(same, F.col("digest") == F.col("same"), "left")
    return joined.select("page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_archives(decided: DataFrame) -> DataFrame:
    """Writes the records; the manifest has address, n_records and n_bytes of each archive."""
    base = scratch(decided.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in slices(batches, "html"):
            for page, url, html, digest, first in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                writer = writer or ArchiveWriter(base)
                writer.add(record(page, url, html.encode(), digest, first))
                if writer.size >= ARCHIVE_BYTES:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        yield pa.RecordBatch.from_pylist(done, schema=pa.schema([("address", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())]))

    return written(decided.mapInArrow(run, MANIFEST), "archives")


def read_archives(manifest: DataFrame) -> DataFrame:
    """Per record of all archives: page_id, payload_bytes, payload_digest, record_type, refers_to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = lambda held, name: int(held[name]) if name in held else None
        for batch in batches:
            for row in batch.to_pylist():
                found = []
                for held, _ in records(read_file(row["address"])):
                    digest = held.get("warc-payload-digest", "").removeprefix("sha256:")
                    found.append((whole(held, "x-page-id"), number(held, "x-payload-length"), digest, held["warc-type"], whole(held, "x-refers-to-page-id")))
                if len(found) != row["n_records"]:
                    raise WarcError(f"{row['address']} has {len(found)} records, not {row['n_records']}")
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*found, strict=True), kinds, strict=True)], names)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return manifest.repartition(max(1, manifest.count())).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def web_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes every page as a record and reads the archives back, see the functions above.

    Null html is an empty payload and a null url leaves the address out. Pages under the
    smallest id of a payload are responses, also if that id is repeated; pages with a null
    id refer to it; a payload all of whose ids are null is stored every time. An empty
    table gives no archive and no row; other columns are not looked at.
    """
    return read_archives(write_archives(decide(pages, id_col, url_col, html_col)))
