"""Quality rules, near duplicates, classifiers and passage search against plain versions."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import LONG, frame
from tidalframe.llm import dartminhash, divergence, fmindex, learning, quality, toxicity
from tidalframe.llm.store import numbered


def test_numbers_have_no_gaps_in_a_hot_group(spark):
    rows = spark.range(3000).selectExpr("if(id % 2 = 0, null, id % 7) as g", "id")
    out = numbered(rows, ["g"], ["id"], "k").collect()
    held = {}
    for r in out:
        held.setdefault(r.g, []).append(r.k)
    assert sum(map(len, held.values())) == 3000 and all(sorted(x) == list(range(len(x))) for x in held.values())


# Quality rules


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines, seen, again = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered)


def test_base_counts_of_odd_rows(spark, odd_rows, nothing):
    rng = random.Random(2)
    rows = odd_rows + [(100 + k, "".join(rng.choices(["a", "b", " ", "\n", "#", "é", "　", "\x0b", "\x1c", "a b\n"], k=rng.randint(0, 80)))) for k in range(300)]
    got = divergence.quality_rules(frame(spark, rows)).collect()
    want = Counter((r[0], *base(r[1])) for r in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept) for r in got)
    assert divergence.quality_rules(nothing).count() == 0


def prose(rng, n):
    return " ".join(rng.choices(["the", "of", "and"], k=1)[0] if rng.random() < 0.3 else "".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(n)) + "."


def js(p, q):
    p, q = np.array(p, float) / sum(p), np.array(q, float) / sum(q)
    m = (p + q) / 2
    kl = lambda x: sum(a * np.log2(a / b) for a, b in zip(x, m, strict=True) if a > 0)
    return np.sqrt(max(0, (kl(p) + kl(q)) / 2))


def test_distances_against_plain_histograms(spark):
    rng = random.Random(4)
    texts = [prose(rng, rng.randint(60, 200)) for _ in range(60)] + [" ".join(w + "***" for w in prose(rng, 90).split()), prose(rng, 90).upper() + "!!", prose(rng, 10)]
    got = {r.doc_id: r for r in divergence.quality_rules(frame(spark, list(enumerate(texts)))).collect()}
    assert all(got[k].kept for k in range(60)) and not got[60].kept and not got[61].kept
    classes = [np.bincount(divergence.CLASS_OF[np.frombuffer(t.encode(), np.uint8)], minlength=9)[:8] for t in texts]
    reference = sum(c for k, c in enumerate(classes) if not got[k].base_failed)
    assert got[3].class_distance == pytest.approx(js(classes[3], reference))
    common = Counter()
    for t in texts:
        words = Counter(t.lower().split())
        common.update(w for w, n in words.items() if n >= 3 and n >= 0.01 * words.total())
    listed = [w for w, _ in sorted(common.items(), key=lambda x: (-x[1], x[0].encode()))[:32]]
    place = {w: k for k, w in enumerate(listed)}
    held = [np.bincount([place.get(w, 32) for w in t.lower().split()], minlength=33) for t in texts]
    reference = sum(h for k, h in enumerate(held) if not got[k].base_failed)
    assert got[3].word_distance == pytest.approx(js(held[3], reference))


def test_short_languages_and_texts_are_not_compared(spark):
    got = divergence.quality_rules(frame(spark, [(1, "## " * 60 + " ".join(f"w{k}" for k in range(80)), "xx")])).collect()
    assert got[0].class_distance is None and got[0].kept


def spoken(rng, common, n):
    return " ".join(rng.choice(common) if rng.random() < 0.25 else "".join(rng.choices("abcdefghijklmno", k=rng.randint(5, 9))) for _ in range(n))


def test_text_of_another_language_or_without_common_words_is_rejected(spark):
    rng = random.Random(9)
    # The two languages share three common words in twelve.
    common = {"xx": "de la en mu ro ti sa po ke lu vi no".split(), "yy": "de la en der und das mit von zu ist auf ein".split()}
    rows = [(k, spoken(rng, common[lang], rng.randint(50, 400)), lang) for k, lang in enumerate(["xx", "yy"] * 150)]
    wrong = [(1000 + k, spoken(rng, common["yy" if lang == "xx" else "xx"], rng.randint(200, 400)), lang) for k, lang in enumerate(["xx", "yy"] * 8)]
    wrong += [(2000 + k, spoken(rng, ["".join(rng.choices("pqrstuv", k=4)) for _ in range(999)], n), lang) for k, (n, lang) in enumerate([(50, "xx"), (70, "yy"), (150, "xx"), (900, "yy")])]
    got = {r.doc_id: r for r in divergence.quality_rules(frame(spark, rows + wrong)).collect()}
    assert not any(got[r[0]].base_failed for r in rows + wrong)
    assert [r[0] for r in rows if not got[r[0]].kept] == [] and [r[0] for r in wrong if got[r[0]].kept] == []
    assert max(got[r[0]].word_distance for r in wrong) < divergence.WORD_DISTANCE and max(got[r[0]].class_distance for r in wrong) < divergence.CLASS_DISTANCE


def test_a_language_with_few_common_words_keeps_texts_without_them():
    reference = np.array([20] + [0] * 31 + [980])
    assert divergence.word_limits(np.array([50, 400]), reference)[0] == divergence.WORD_DISTANCE
    without = divergence.distances(np.eye(33)[32:], reference)[0]
    assert divergence.word_limits(np.array([5000]), reference)[0] < without
    assert divergence.word_limits(np.array([50]), np.eye(33)[32])[0] == divergence.WORD_DISTANCE


# Near duplicates


def sets(texts):
    split = [t.lower().split() for t in texts]
    return [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else None for w in split]


def classes(texts, threshold=0.8):
    held, parent = sets(texts), list(range(len(texts)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            a, b = held[i], held[j]
            if texts[i] == texts[j] or a and b and len(a & b) >= threshold * len(a | b):
                x, y = top(i), top(j)
                parent[max(x, y)] = min(x, y)
    heads = [top(k) for k in range(len(texts))]
    return [(x, heads.count(x)) for x in heads]


def varied(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates_against_all_pairs(spark):
    rng, texts = random.Random(7), []
    for _ in range(25):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(3, 200))]
        texts += [varied(rng, words, rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randint(1, 12))]
    passage = [f"c{k}" for k in range(60)]
    texts += [" ".join(passage + [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(5, 60))]) for _ in range(60)]
    texts += ["", "", "a", "a", " ", "A"]
    got = {r.doc_id: (r.class_id, r.class_size) for r in dartminhash.near_duplicates(frame(spark, list(enumerate(texts)))).collect()}
    assert [got[k] for k in range(len(texts))] == classes(texts)


def test_a_chain_is_one_class(spark):
    words = [f"w{k}" for k in range(100)]
    texts = [" ".join(words[k * 4 :] + [f"n{j}" for j in range(k * 4)]) for k in range(8)]
    got = {r.doc_id: (r.class_id, r.class_size) for r in dartminhash.near_duplicates(frame(spark, list(enumerate(texts)))).collect()}
    assert [got[k] for k in range(8)] == classes(texts) and {x for x, _ in got.values()} == {0}


def test_near_duplicates_of_odd_rows(odd, odd_rows, nothing):
    rows = dartminhash.near_duplicates(odd).collect()
    assert len(rows) == len(odd_rows)
    assert sorted(r.class_size for r in rows if r.doc_id == 4) == [1, 2, 2]
    assert sum(r.first for r in rows) == len(odd_rows) - 1
    assert dartminhash.near_duplicates(nothing).count() == 0
    kept = dartminhash.deduplicated(odd)
    assert kept.dtypes == odd.dtypes and kept.count() == len(odd_rows) - 1
    assert kept.where("doc_id = 4").count() == 2 and kept.where("doc_id IS NULL AND text IS NULL").count() == 1


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 1 << 63, 360).astype(np.uint64)
    wa, wb = rng.uniform(0.2, 3, 360), rng.uniform(0.2, 3, 360)
    wa[300:], wb[:60] = 0.0, 0.0
    with np.errstate(over="ignore"):
        a, b = dartminhash.signatures(np.concatenate([keys[wa > 0], keys[wb > 0]]), np.concatenate([wa[wa > 0], wb[wb > 0]]), np.repeat([0, 1], [300, 300]), 2, 6000)
        one = dartminhash.signatures(keys[:1], np.array([2.0]), np.zeros(1, np.int64), 2, 8)
    assert (a == b).mean() == pytest.approx(np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum(), abs=0.025)
    assert (one[0] != one[1]).all() and (one[1] == np.iinfo(np.uint64).max).all()


def test_weighted_classes_count_repeats(spark):
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(words), " ".join(words + words[:5] * 30)]
    frame_ = frame(spark, list(enumerate(texts)))
    assert dartminhash.near_duplicates(frame_).select("class_id").distinct().count() == 1
    assert dartminhash.near_duplicates(frame_, weighted=True).select("class_id").distinct().count() == 2


def test_a_large_group_of_unlike_copies_is_closed(spark):
    """Copies of one text, most of them too far from each other but near to the first."""
    rng = random.Random(11)
    words = [f"w{k}" for k in range(120)]
    texts = [varied(rng, words, 3) for _ in range(120)] + [" ".join(words)] + [varied(rng, words, 12) for _ in range(30)]
    rng.shuffle(texts)
    got = {r.doc_id: (r.class_id, r.class_size) for r in dartminhash.near_duplicates(frame(spark, list(enumerate(texts)))).collect()}
    want = classes(texts)
    missed = sum(got[k] != want[k] for k in range(len(texts)))
    assert missed == 0, missed


# Passages


def plain_search(texts, items, window):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    for text in texts:
        own = words(text)
        hit, found = [False] * len(own), set()
        for item, sought in items:
            asked = words(sought)
            for k in range(max(1, len(asked) - window + 1)) if asked else ():
                p = asked[k : k + window]
                for at in range(len(own) - len(p) + 1):
                    if own[at : at + len(p)] == p:
                        found.add(item)
                        hit[at : at + len(p)] = [True] * len(p)
        out.append((len(own), sum(hit), found, own, hit))
    return out


@pytest.mark.parametrize("block", [4, 1000])
def test_passages_against_plain_search(spark, monkeypatch, block):
    monkeypatch.setattr(fmindex, "BLOCK_ITEMS", block)
    rng = random.Random(9)
    pick = lambda n, extra: " ".join(rng.choices(["Ab", "ÉT", "c9", "d", "e", "F", *extra], k=n))
    for window in (3, 10):
        items = [(k, pick(rng.randint(0, 14), [])) for k in range(12)] + [(50, None), (51, "!!")]
        texts = [pick(rng.randint(0, 60), ["zz", "-", "yy,"]) for _ in range(80)] + [None, "", "... !"] + [f"zz {t} zz" for _, t in items if t]
        benchmark = spark.createDataFrame(items, "item_id long, text string")
        rows = {r.doc_id: r for r in fmindex.contamination(frame(spark, list(enumerate(texts))), benchmark, window).collect()}
        for k, (n, hits, found, own, hit) in enumerate(plain_search(texts, items, window)):
            r = rows[k]
            assert (r.n_words, r.n_hit, set(r["items"])) == (n, hits, found)
            left = [w for w, h in zip(own, hit, strict=True) if not h]
            assert fmindex.words(r.text) == [w.encode() for w in left] and (texts[k] is None) == (r.text is None)


def test_passages_of_odd_rows(spark, odd, odd_rows, nothing):
    benchmark = spark.createDataFrame([(1, "the same ROW"), (1, "the same ROW"), (2, LONG[:300]), (None, "lonely")], "item_id long, text string")
    rows = fmindex.digest(fmindex.contamination(odd, benchmark)).collect()
    assert len(rows) == len(odd_rows)
    assert sorted((r.n_hit, r.n_items) for r in rows if r.doc_id == 4) == [(0, 0), (3, 1), (3, 1)]
    assert next(r for r in rows if r.doc_id == 3).contaminated
    assert fmindex.digest(fmindex.contamination(nothing, benchmark)).count() == 0
    none = fmindex.digest(fmindex.contamination(odd, benchmark.limit(0))).collect()
    assert not any(r.contaminated for r in none) and len(none) == len(odd_rows)


def test_a_frequent_passage_is_placed_in_blocks(monkeypatch):
    monkeypatch.setattr(fmindex, "PLACED", 7)
    sought = fmindex.Phrases([(5, "a a")], 10)
    spans, items = fmindex.search_shard([np.ones(50, np.int64), np.array([1, 0, 1], np.int64), np.zeros(0, np.int64)], sought)
    assert spans == [[0, 50], [], []] and items == [[5], [], []]


# Classifiers


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_tells_marked_words_from_prose(spark):
    rng = random.Random(1)
    rows = [(k, prose(rng, 80) if k % 3 else " ".join(w + rng.choice(["***", "$$$"]) for w in prose(rng, 80).split())) for k in range(400)]
    labels = labelled(spark, [(k, int(k % 3 > 0), 0) for k in range(400)] + [(None, 1, 1), (3, None, None)])
    got = {r.doc_id: r for r in quality.quality_scores(frame(spark, rows), labels).collect()}
    held = [k for k in range(400) if got[k].held_out]
    assert 40 < len(held) < 130 and held == [k for k in range(400) if __import__("zlib").crc32(str(k).encode()) % 5 == 0]
    assert all(got[k].predicted == int(k % 3 > 0) == int(got[k].score >= 0.3) for k in held)


def test_machine_learns_a_pair_that_no_weight_shows():
    """Two terms that are toxic together and only together."""
    rng, texts, y = np.random.default_rng(3), [], []
    for _ in range(3000):
        a, b = rng.random(2) < 0.4
        texts.append(" ".join(["insult"] * int(a) + ["group"] * int(b) + [f"n{k}" for k in rng.integers(0, 40, 6)]))
        y.append(int(a and b))
    y = np.array(y)
    machine = toxicity.fit(*toxicity.terms(texts), y)
    score = machine.score(*toxicity.terms(["insult", "group", "insult group", ""]), 4)
    assert score[2] > 0.5 > max(score[0], score[1]) and score[3] < 0.5


def test_machine_learns_a_pair_without_any_effect_alone():
    """Toxic if exactly one of two words occurs: neither word alone tells anything."""
    rng, texts, y = np.random.default_rng(5), [], []
    for _ in range(4000):
        a, b = rng.random(2) < 0.5
        texts.append(" ".join(["alpha"] * int(a) + ["beta"] * int(b) + [f"n{k}" for k in rng.integers(0, 40, 6)]))
        y.append(int(a != b))
    machine = toxicity.fit(*toxicity.terms(texts), np.array(y))
    score = machine.score(*toxicity.terms(["alpha n1", "beta n2", "alpha beta n3", "n4"]), 4)
    assert min(score[:2]) > 0.9 and max(score[2:]) < 0.1


def test_machine_against_all_pairs():
    rng = np.random.default_rng(2)
    machine = toxicity.Machine(np.arange(20), np.array([0.3]), rng.normal(size=20), rng.normal(size=(20, 3)))
    held = [sorted(set(rng.integers(0, 20, k).tolist())) for k in (0, 1, 5, 12)]
    logit, _ = machine.parts(np.array([t for x in held for t in x], np.int64), np.repeat(np.arange(4), [len(x) for x in held]), 4)
    for x, got in zip(held, logit, strict=True):
        pairs = sum(machine.factor[a] @ machine.factor[b] for a in x for b in x if a < b)
        assert got == pytest.approx(0.3 + sum(machine.weight[a] for a in x) + pairs)


def test_the_terms_learnt_from_are_bounded(spark):
    learnt = spark.range(3000).selectExpr("id AS doc_id", "sequence(0, cast(id % 20 AS int)) AS terms")
    few = toxicity.bounded(learnt, 5000)
    assert 3000 < few.selectExpr("sum(size(terms))").first()[0] <= 5000 and toxicity.bounded(learnt, 10**6).count() == 3000


def test_a_machine_is_fitted_in_little_more_than_its_terms():
    rng = np.random.default_rng(2)
    n, per = 4000, 60
    key = np.unique(np.repeat(np.arange(n), per) * toxicity.BUCKETS + rng.zipf(1.3, n * per) % 3000)
    doc, bucket = (key // toxicity.BUCKETS).astype(np.int32), (key % toxicity.BUCKETS).astype(np.int32)
    y = (rng.random(n) < 0.2).astype(int)
    tracemalloc.start()
    try:
        toxicity.fit(bucket, doc, y)
        assert tracemalloc.get_traced_memory()[1] < 45e6
    finally:
        tracemalloc.stop()


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(6)
    rows = [(k, prose(rng, 50) + (" You are scum, an idiot." if k % 5 == 0 else "")) for k in range(500)]
    labels = labelled(spark, [(k, 1, int(k % 5 == 0)) for k in range(500)])
    got = {r.doc_id: r for r in toxicity.toxicity_scores(frame(spark, rows), labels).collect()}
    held = [k for k in got if got[k].held_out]
    assert sum(got[k].predicted == int(k % 5 == 0) for k in held) >= 0.98 * len(held)


def test_pooled_vectors_against_plain_ones():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["Word", "word", "a1b22", "***", "ünder", "x\u00a0y", "_", "7"]) for _ in range(rng.randint(0, 30))) for _ in range(25)]
    vectors = np.random.default_rng(1).normal(size=(quality.BUCKETS, quality.DIM)).astype(np.float32)
    got = quality.pooled(pa.array([*texts, None], pa.string()), vectors)
    for text, row in zip([*texts, ""], got, strict=True):
        own = [b for w in text.split() for b in quality.parts_of(w)]
        if not own:
            assert not row.any()
            continue
        held = vectors[own]
        assert row[: quality.DIM] == pytest.approx(held.mean(0), abs=1e-4) and row[quality.DIM : 2 * quality.DIM] == pytest.approx(held.std(0), abs=1e-3)
        assert row[-3] == pytest.approx(np.log1p(len(own))) and row[-2] == pytest.approx(len(set(own)) / len(own))


def test_word_vectors_against_plain_neighbours(spark):
    texts = ["a b a c", "b c", None, "c c c a b d"]
    got = quality.word_vectors(frame(spark, list(enumerate(texts))))
    place, sign = quality.index_vectors()
    plain = np.zeros((quality.BUCKETS, quality.DIM))
    for text in texts:
        own = [b for w in (text or "").split() for b in quality.parts_of(w)]
        for i, x in enumerate(own):
            for j in range(max(0, i - quality.REACH), min(len(own), i + quality.REACH + 1)):
                if i != j:
                    np.add.at(plain[x], place[own[j]], sign[own[j]])
    norm = np.linalg.norm(plain, axis=1, keepdims=True)
    used = norm[:, 0] > 0
    plain[used] /= norm[used]
    plain[used] -= plain[used].mean(axis=0)
    assert np.allclose(got, plain, atol=1e-5)


@pytest.mark.parametrize("score", [quality.quality_scores, toxicity.toxicity_scores])
def test_classifiers_of_odd_rows(spark, score, odd, odd_rows, nothing):
    labels = labelled(spark, [(3, 1, 0), (4, 0, 1), (4, 1, 0), (9, 1, 1), (None, 0, 0)])
    for known in (labels, labels.limit(0)):
        rows = score(odd, known).collect()
        assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 2 or r.doc_id == 1}) == 1
    assert score(nothing, labels).count() == 0


def test_labels_of_a_document_are_one(spark):
    rows = learning.known_labels(labelled(spark, [(1, 0, None), (1, 1, 1), (None, 1, 1), (2, None, 0)]), "quality").collect()
    assert [tuple(r) for r in rows] == [(1, 0)]


def test_a_network_scores_a_row_alike_beside_any_others():
    rng = np.random.default_rng(2)
    layers = [rng.normal(size=(quality.VECTOR, quality.HIDDEN)), rng.normal(size=quality.HIDDEN), rng.normal(size=quality.HIDDEN), rng.normal(size=1)]
    net, x = quality.Network(np.zeros(quality.VECTOR), np.ones(quality.VECTOR), layers), rng.normal(size=(301, quality.VECTOR))
    every = net.logit(x)
    for n in (1, 2, 3, 5, 8, 100):
        for at in range(0, 301, n):
            assert (net.logit(x[at : at + n]) == every[at : at + n]).all()
