"""Registered queries over the tables of text, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidalframe.llm import dartminhash, divergence, exact_dedup, fmindex, infilling, kdtree, packing, phrases, quality, token_counts, token_files, toxicity, warc
from tidalframe.sources.tables import table


def tokenizer(name: str) -> str:
    """Where a public tokenizer's file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack(table(spark, root, "documents"), tokenizer("word_bpe_49k.json"))


def op2_wavelet_tokens(spark: SparkSession, root: str) -> DataFrame:
    return token_files.token_files(table(spark, root, "documents"), tokenizer("byte_bpe_50k.json"))


def op3_kd_sharding(spark: SparkSession, root: str) -> DataFrame:
    return kdtree.document_shards(table(spark, root, "documents"))


def op4_divergence_rules(spark: SparkSession, root: str) -> DataFrame:
    found = divergence.quality_rules(table(spark, root, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_dart_minhash(spark: SparkSession, root: str) -> DataFrame:
    return dartminhash.near_duplicates(table(spark, root, "documents")).select("doc_id", "class_id", "class_size")


def op6_quality_network(spark: SparkSession, root: str) -> DataFrame:
    return quality.quality_scores(table(spark, root, "documents"), table(spark, root, "labels"))


def op7_fm_decontamination(spark: SparkSession, root: str) -> DataFrame:
    return fmindex.digest(fmindex.contamination(table(spark, root, "documents"), table(spark, root, "benchmark")))


def op8_toxicity_machine(spark: SparkSession, root: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, root, "documents"), table(spark, root, "labels"))


def op9_token_counts(spark: SparkSession, root: str) -> DataFrame:
    return token_counts.token_counts(table(spark, root, "documents"), tokenizer("piece_bpe_32k.model"))


def op10_web_archive(spark: SparkSession, root: str) -> DataFrame:
    return warc.web_archive(table(spark, root, "pages"))


def op11_exact_dedup(spark: SparkSession, root: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, root, "documents"))


def op12_setm_phrases(spark: SparkSession, root: str) -> DataFrame:
    return phrases.collocations(table(spark, root, "documents"))


def op13_counted_infilling(spark: SparkSession, root: str) -> DataFrame:
    return infilling.digest(table(spark, root, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_wavelet_tokens,
        op3_kd_sharding,
        op4_divergence_rules,
        op5_dart_minhash,
        op6_quality_network,
        op7_fm_decontamination,
        op8_toxicity_machine,
        op9_token_counts,
        op10_web_archive,
        op11_exact_dedup,
        op12_setm_phrases,
        op13_counted_infilling,
    )
}

ORACLES: dict[str, str] = {
    "op7_fm_decontamination": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS ws FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS ws FROM benchmark),
        q AS (SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[k : k + least(len(ws), 10) - 1], ' ') AS win
              FROM b, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) t(k) WHERE len(ws) > 0),
        sizes AS (SELECT DISTINCT n FROM q),
        d AS (SELECT doc_id, s.n, k, array_to_string(ws[k : k + s.n - 1], ' ') AS win
              FROM w, sizes s, unnest(range(1, len(ws) - s.n + 2)) t(k) WHERE len(ws) >= s.n),
        hit AS (SELECT d.doc_id, d.k, d.n, q.item_id FROM d JOIN q ON d.n = q.n AND d.win = q.win),
        places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(k, k + n)) t(p) GROUP BY doc_id),
        items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS listed FROM hit GROUP BY doc_id)
        SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM w LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op10_web_archive": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)
    """,
    "op11_exact_dedup": r"""
        WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents),
        g AS (SELECT doc_id, body, first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
    """,
    "op12_setm_phrases": r"""
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
                          unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                        FROM documents),
        w AS (SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
        o AS (SELECT lang, p, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w),
        x AS (SELECT lang, w AS w1, lead(w, 1) OVER q AS w2, lead(w, 2) OVER q AS w3, lead(w, 3) OVER q AS w4 FROM o WINDOW q AS (PARTITION BY p ORDER BY i)),
        g AS (SELECT lang, 1 AS k, w1 AS phrase FROM x UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM x WHERE w2 IS NOT NULL
              UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM x WHERE w3 IS NOT NULL
              UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM x WHERE w4 IS NOT NULL),
        f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
        totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k AS size, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND a >= 30),
        cuts AS (SELECT lang, phrase, a, size, ws, j, array_to_string(ws[1 : j], ' ') AS head, array_to_string(ws[j + 1 : size], ' ') AS tail
                 FROM c, unnest(range(1, size)) t(j)),
        m AS MATERIALIZED (SELECT * FROM f WHERE a >= 30),
        scored AS (SELECT u.lang, u.phrase, u.a, x.a AS l, y.a AS r, u.j, (2000000::HUGEINT * u.a) // (x.a + y.a) AS score
                   FROM cuts u JOIN m x ON x.lang = u.lang AND x.phrase = u.head JOIN m y ON y.lang = u.lang AND y.phrase = u.tail),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        around AS (SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, max(a) AS longer
                   FROM c, unnest(range(2, size)) s(m), unnest(range(1, size - m + 2)) t(i) GROUP BY ALL),
        ranked AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank, b.phrase, a, l, r, score
                   FROM best b LEFT JOIN around USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a)
        SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
    "op13_counted_infilling": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                     sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
        h AS (SELECT doc_id, text, u, len(u) AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2,
                ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM t),
        c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS x, greatest(h1 % (n + 1), h2 % (n + 1)) AS y,
                CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                     WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
        p AS (SELECT *, array_to_string(u[1 : x], '') AS pre, array_to_string(u[x + 1 : y], '') AS mid, array_to_string(u[y + 1 : n], '') AS suf FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM p
    """,
}
