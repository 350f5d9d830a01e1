"""Exact duplicates, phrase mining and infilling against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import LONG, frame
from tidalframe.llm import exact_dedup, infilling, phrases


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Exact duplicates


def body(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def groups_right(rows, got):
    """Each row's group by plain comparison, and one row kept of each."""
    held = {}
    for doc_id, text in rows:
        held.setdefault(body(text), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    want = Counter((doc_id, min(held[body(text)])[3], len(held[body(text)]), sha(body(text))) for doc_id, text in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted(map(sha, held)) and all(r.doc_id == r.keep_id for r in kept)


def copies(rng, n):
    texts = ["".join(rng.choices("ab \n\x0b\x1cé", k=rng.randint(0, 6))) for _ in range(n)]
    return [(k if k % 17 else None, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("hash", [exact_dedup.hashed, lambda c: F.unhex(F.substring(F.md5(c), 1, 2))])
def test_exact_groups_against_plain_comparison(spark, odd_rows, hash):
    rows = copies(random.Random(5), 700) + [(r[0], r[1]) for r in odd_rows] + [(9000 + k, "one hot text") for k in range(600)]
    groups_right(rows, exact_dedup.exact_duplicates(frame(spark, rows).repartition(7), hash=hash).collect())


def test_exact_dedup_keeps_columns_and_takes_empty_tables(odd, odd_rows, nothing):
    kept = exact_dedup.deduplicated(odd)
    assert kept.dtypes == odd.dtypes and kept.count() == len({body(r[1]) for r in odd_rows})
    assert kept.where("doc_id = 5").count() == 1 and kept.where("doc_id = 4").count() == 2
    assert exact_dedup.exact_duplicates(nothing).count() == 0 and exact_dedup.deduplicated(nothing).count() == 0


# Infilling


def plain_infill(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_infilling_against_a_plain_version(spark, odd_rows):
    rng = random.Random(8)
    parts = ["word", "A", " ", "\n", "é", "日本", "😀", "<", "P", ">", "S>", "$1", "\\", "{3}", "\x00", " ", "\r\n"]
    rows = [(r[0], r[1]) for r in odd_rows] + [(100 + k, "".join(rng.choices(parts, k=rng.randint(0, 40)))) for k in range(400)]
    rows += [(600, "a <P> b"), (601, "<M>"), (602, "x " * 200_000), (603, LONG)]
    got = infilling.infilled(frame(spark, rows)).collect()
    want = Counter((doc_id, *plain_infill(doc_id, text)) for doc_id, text in rows)
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_infilled_texts_come_back(spark, odd, nothing):
    rows = infilling.infilled(odd).withColumn("again", infilling.restored(F.col("form"), F.col("output"))).collect()
    assert all(r.again == (r.text or "") and r.source == "s" for r in rows)
    assert all(r.restored_sha256 == sha(t) for r, t in zip(infilling.digest(odd).collect(), [r.text or "" for r in odd.collect()], strict=True))
    assert infilling.digest(nothing).count() == 0


def test_every_share_of_infilling(spark):
    rows = spark.range(2000).selectExpr("id AS doc_id", "'some words to cut' AS text")
    forms = {r.form: r["count"] for r in infilling.infilled(rows, seed=7, percent=50, spm_percent=50).groupBy("form").count().collect()}
    assert 900 < forms["plain"] < 1100 and 400 < forms["psm"] < 600 and 400 < forms["spm"] < 600
    assert infilling.infilled(rows, percent=0).filter("output <> text").count() == 0


# Phrases


def plain_phrases(rows, least, longest, share, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f.update((lang, tuple(words[k : k + size])) for k in range(len(words) - size + 1))
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    dropped = set()
    for (lang, p), a in candidates.items():
        for size in range(2, len(p)):
            for k in range(len(p) - size + 1):
                inner = (lang, p[k : k + size])
                if 100 * a >= share * f[inner]:
                    dropped.add(inner)
    out = []
    for lang in n:
        scored = []
        for (own, p), a in candidates.items():
            if own == lang and (own, p) not in dropped:
                cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, k + 1, p.decode(), -a, left, right, n[lang], -score) for k, (score, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return Counter(out)


def prose(rng, n):
    words = ["the", "The", "of", "ünd", "a", "b", "c", "in", "new", "york", "日本", "x\x1cy"]
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(n))


@pytest.mark.parametrize("slice_bytes", [300, 1 << 20])
@pytest.mark.parametrize("longest", [4, 5])
def test_phrases_against_plain_counts(spark, odd_rows, slice_bytes, longest):
    rng = random.Random(3)
    rows = [(k, prose(rng, rng.randint(0, 60)), rng.choice(["en", "de", None, "und", ""])) for k in range(150)]
    rows += [(1000 + k, "say in new york city now", "en") for k in range(40)] + [(2000, "one long piece of a b " * 300, "en")]
    rows += [(r[0], r[1], r[2] if len(r) > 2 else "en") for r in odd_rows]
    for top in (2000, 5):
        got = phrases.collocations(frame(spark, rows).repartition(3), least=8, longest=longest, share=80, top=top, slice_bytes=slice_bytes).collect()
        assert Counter(tuple(r) for r in got) == plain_phrases(rows, 8, longest, 80, top)


def test_no_phrases_in_empty_or_short_tables(spark, nothing):
    assert phrases.collocations(nothing).count() == 0
    assert phrases.collocations(frame(spark, [(1, None), (2, " . "), (3, "single")])).count() == 0
    assert phrases.collocations(frame(spark, [(1, "again " * 40, None)])).select("lang", "phrase", "a").collect() == [("und", "again again again again", 37)]


def test_scores_beyond_64_bits(spark):
    row = spark.createDataFrame([(4 * 10**18, [4 * 10**18, 4 * 10**18 + 1], [5 * 10**18, 4 * 10**18 + 3])], "total long, heads array<long>, tails array<long>")
    cut = row.select(phrases.best_cut("total", "heads", "tails").alias("c")).first().c
    plain = min((2_000_000 * 4 * 10**18 // (left + right), k, left, right) for k, left, right in ((1, 4 * 10**18, 4 * 10**18 + 3), (2, 4 * 10**18 + 1, 5 * 10**18)))
    assert tuple(cut) == plain


def test_long_texts_are_cut_between_pieces():
    text = b"aa bb, cc dd." * 50 + b"e" * 500 + b"! f g"
    parts = list(phrases.chunks(text, 40))
    assert b"".join(parts) == text and len(parts) > 5 and all(p[-1:] in b".,!" for p in parts[:-1])
    assert list(phrases.chunks(b"x" * 100, 7)) == [b"x" * 100] and list(phrases.chunks(b"", 7)) == [b""]
