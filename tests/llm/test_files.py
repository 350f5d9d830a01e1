"""K-d sharding and web archives."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from tests.llm.conftest import frame
from tidalframe.llm import kdtree, warc


def gapless(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    return all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_odd_rows(odd, odd_rows, nothing):
    rows = kdtree.document_shards(odd).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in odd_rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    assert gapless(rows) and all(0 <= r.shard < 40 and r.law == "bytes" and r.grown_shard is None for r in rows)
    assert kdtree.document_shards(nothing).count() == 0


def test_shards_of_equal_bytes_beside_a_hot_value(spark):
    rows = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("x"), (F.col("id") % 11 + 1).alias("w"))
    out = kdtree.kd_shards(rows, [F.col("x"), F.lit(1), F.col("w")], F.col("w"), [F.col("id")], 13).collect()
    assert len({r.id for r in out}) == len(out) == 6000 and gapless(out)
    sizes = Counter()
    for r in out:
        sizes[r.shard] += r["size"]
    mean = sum(sizes.values()) / 13
    assert set(sizes) == set(range(13)) and all(abs(s - mean) <= 4 * 12 for s in sizes.values())


def test_equal_rows_are_divided(spark):
    out = kdtree.kd_shards(spark.range(1000).select(F.lit(1).alias("id")), [F.col("id")], F.lit(10), [F.col("id")], 8).collect()
    assert sorted(Counter(r.shard for r in out).values()) == [125] * 8 and gapless(out)


def test_the_tree_cuts_the_widest_dimension(spark):
    rows = spark.range(64).select("id", (F.col("id") % 8).alias("a"), F.floor(F.col("id") / 8).alias("b"))
    out = kdtree.kd_shards(rows, [F.col("a"), F.col("b")], F.lit(1), [F.col("a"), F.col("b")], 4).collect()
    boxes = defaultdict(set)
    for r in out:
        boxes[r.shard].add((r.a // 4, r.b // 4))
    assert all(len(b) == 1 for b in boxes.values()) and len({next(iter(b)) for b in boxes.values()}) == 4


def test_sharding_runs_no_python(odd):
    plan = kdtree.document_shards(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


PAGES = "page_id long, url string, html string, digest string, first long, n int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, 2) for r in rows], PAGES)


def test_archives_of_odd_rows(spark):
    big, same = "é" * 80, "z" * 100
    rows = [(9, "http://a/", same), (4, None, same), (4, "http://b/\r\nx", same), (None, "u", same), (7, "u", "short"), (8, "u", "short"), (1, "u", None), (2, "u", ""), (None, None, big), (None, "v", big), (5, "u", "w" * 2_000_000), (6, "u", "z" * 99)]
    got = [tuple(r) for r in warc.web_archive(pages(spark, rows)).collect()]
    first = defaultdict(list)
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h].append(i)
    want = []
    for i, _, h in rows:
        data, to = (h or "").encode(), min(first[h]) if first.get(h) else None
        again = to is not None and i != to
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", to if again else None))
    assert Counter(got) == Counter(want)
    assert warc.web_archive(pages(spark, [])).count() == 0


def archive(payloads, dictionary=b"", packed=False):
    import struct

    held = zstandard.ZstdCompressor().compress(dictionary) if packed else dictionary
    words = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if dictionary else None
    squeeze = zstandard.ZstdCompressor(dict_data=words) if words else zstandard.ZstdCompressor()
    head = struct.pack("<II", warc.SKIPPABLE, len(held)) + held if dictionary else b""
    return head + b"".join(squeeze.compress(p) for p in payloads)


def test_reader_takes_either_form_of_dictionary_and_none():
    some = [warc.record(k, "http://x/", b"payload %d" % k * 5000, hashlib.sha256(b"payload %d" % k * 5000).hexdigest(), None) for k in range(5)]
    for data in (archive(some), archive(some, b"WARC/1.1 payload"), archive(some, b"WARC/1.1 payload", packed=True)):
        found = list(warc.records(data))
        assert [h["x-page-id"] for h, _ in found] == list("01234") and found[3][1] == b"payload 3" * 5000


@pytest.mark.parametrize(
    ("old", "new"),
    [(b"WARC/1.1", b"WARC/9.9"), (b"Content-Length: 7\r\n", b"Content-Length: 8\r\n"), (b"WARC-Date", b"No Date"), (b"payload", b"payloaf"), (b"WARC-Type: response\r\n", b""), (b"payload", b"payload+"), (b"X-Payload-Length: 7", b"X-Payload-Length: 8")],
)
def test_reader_refuses_broken_records(old, new):
    good = warc.record(1, "http://x/", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    assert list(warc.records(archive([good])))[0][1] == b"payload"
    with pytest.raises(warc.WarcError):
        list(warc.records(archive([good.replace(old, new)])))


def test_reader_refuses_cut_and_foreign_files():
    data = archive([warc.record(1, None, b"x" * 100, hashlib.sha256(b"x" * 100).hexdigest(), None)], b"some words")
    for broken in (data[:-3], data[:12], b"plain text file", data[:-1] + bytes([data[-1] ^ 1]) + b"\x00"):
        with pytest.raises(warc.WarcError):
            list(warc.records(broken))


def test_documents_frame_has_clashing_columns(spark):
    assert {"uid", "digest", "node", "sequence_id"} <= set(frame(spark, []).columns)
