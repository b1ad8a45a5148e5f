"""One registered query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from docspark.llm import bpe, decontaminate, html, licenses, linededup, merkle, neardup, packing, quality, substrings, suffixtree, variants, warc
from docspark.sources import staging


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixtree.score(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path)


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substrings.remove_repeats(table(spark, sf_dir, "documents"), window=13)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    state, _ = staging.stage(linededup.references(docs), "references")
    return linededup.judged(docs, state, min_docs=10).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.cluster(table(spark, sf_dir, "documents"), size=4, percent=80).drop("text_hash")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = staging.new_folder(spark, "archives")
    index = warc.write(table(spark, sf_dir, "pages"), folder, min_bytes=0)
    return warc.read(index, folder, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    done = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), ranks), ranks)
    digests = [F.sha2(c, 256).alias(name) for c, name in (("tokens", "ids_sha256"), ("decoded", "decoded_sha256"))]
    return done.select("doc_id", "n_tokens", *digests)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # Every second document loses its line ends.
    bent = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", ""))
    fields = [F.coalesce(bent, F.col(c)) if c == "text" else F.col(c) for c in merkle.FIELDS]
    return merkle.fold(merkle.build(docs, tampered=merkle.leaf_of(*fields)), "tampered")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_license_scans": op4_license_scans,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_quality_rules": op8_quality_rules,
    "op9_minhash_dedup": op9_minhash_dedup,
    "op10_warc": op10_warc,
    "op11_bpe": op11_bpe,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op5_substring_dedup": r"""
        WITH w AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), windows AS (
          SELECT doc_id, nth, array_to_string(ws[nth : nth + 12], ' ') AS run
          FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS nth FROM w WHERE len(ws) >= 13)
        ), firsts AS (
          SELECT run, min(doc_id) AS first_id FROM windows GROUP BY run
        ), gone AS (
          SELECT DISTINCT doc_id, nth + step AS nth
          FROM (SELECT windows.doc_id, nth FROM windows JOIN firsts USING (run) WHERE first_id < windows.doc_id),
            range(13) AS steps(step)
        ), each AS (
          SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS nth FROM w
        ), kept AS (
          SELECT e.doc_id, count(*) FILTER (g.nth IS NOT NULL) AS n_removed,
            coalesce(string_agg(word, ' ' ORDER BY e.nth) FILTER (g.nth IS NULL), '') AS rest
          FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.nth = g.nth GROUP BY e.doc_id
        )
        SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed,
          sha256(coalesce(rest, '')) AS kept_sha256
        FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id""",
    "op6_line_dedup": r"""
        WITH lines AS (
          SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM documents
        ), each AS (
          SELECT doc_id, unnest(all_lines) AS line, generate_subscripts(all_lines, 1) AS nth FROM lines
        ), keyed AS (
          SELECT doc_id, nth, line, translate(
            trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM each
        ), frequent AS (
          SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
        ), marked AS (
          SELECT k.*, f.key IS NOT NULL AS gone FROM keyed k LEFT JOIN frequent f ON k.key = f.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
          sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op9_minhash_dedup": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), shingles AS (
          SELECT DISTINCT doc_id, array_to_string(ws[nth : nth + 3], ' ') AS shingle
          FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS nth FROM w WHERE len(ws) > 0)
        ), sizes AS (
          SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), pairs AS (
          SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
          FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
        ), links AS (
          SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
          WHERE 100 * shared >= 80 * (p.n + q.n - shared)
        ), edges AS (
          SELECT x, y FROM links UNION ALL SELECT y, x FROM links
        ), reached AS (
          SELECT doc_id, doc_id AS other FROM w
          UNION SELECT reached.doc_id, y FROM reached JOIN edges ON other = x
        ), lowest AS (
          SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
        )
        SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
        FROM w JOIN lowest ON w.doc_id = lowest.doc_id LEFT JOIN sizes ON w.doc_id = sizes.doc_id""",
    "op10_warc": """
        WITH p AS (
          SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages
        ), f AS (
          SELECT sha, min(page_id) AS first_id FROM p GROUP BY sha
        ), groups AS (
          SELECT p.*, first_id, list_transform(range(8), lambda i:
            CAST('0x' || substr(p.sha, 5 * CAST(i AS INTEGER) + 1, 5) AS BIGINT)) AS parts
          FROM p JOIN f ON p.sha = f.sha
        ), letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' AS abc)
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
          array_to_string(list_transform(parts, lambda v:
            substr(abc, CAST((v >> 15) & 31 AS INTEGER) + 1, 1)
            || substr(abc, CAST((v >> 10) & 31 AS INTEGER) + 1, 1)
            || substr(abc, CAST((v >> 5) & 31 AS INTEGER) + 1, 1)
            || substr(abc, CAST(v & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
          CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to, url
        FROM groups, letters""",
    "op12_merkle_manifest": r"""
        WITH RECURSIVE crc_table AS (
          SELECT list(r ORDER BY i) AS entries FROM (
            SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, _k:
              CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS r FROM range(256) AS t(i))
        ), ids AS (
          SELECT doc_id, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
            string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))), lambda c, b:
              xor(c // 256, entries[1 + CAST(xor(c % 256, b) AS INTEGER)]))) AS crc FROM documents, crc_table
        ), fields AS (
          SELECT d.doc_id, source, text IS NOT NULL AND crc % 2 = 0 AS bent, concat(
            coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-'),
            coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
            coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head,
            text, replace(text, chr(10), '') AS flat
          FROM documents d JOIN ids ON d.doc_id = ids.doc_id
        ), leaves AS (
          SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos,
            sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
            sha256(head || CASE WHEN bent THEN strlen(flat) || ':' || flat ELSE coalesce(strlen(text) || ':' || text, '-') END)
              AS changed
          FROM fields
        ), trees AS (
          SELECT 0 AS level, source, pos, leaf AS h FROM leaves
          UNION ALL
          SELECT level + 1, source, pos // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM (
            SELECT *, count(*) OVER (PARTITION BY source) AS n FROM trees) WHERE n > 1 GROUP BY level, source, pos // 3
        ), heights AS (
          SELECT source, max(level) AS height FROM trees GROUP BY source
        ), subroots AS (
          SELECT t.source, h, row_number() OVER (ORDER BY t.source NULLS FIRST) - 1 AS pos
          FROM trees t JOIN heights g ON t.source IS NOT DISTINCT FROM g.source AND level = height
        ), heads AS (
          SELECT 0 AS level, pos, h FROM subroots
          UNION ALL
          SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM (
            SELECT *, count(*) OVER () AS n FROM heads) WHERE n > 1 GROUP BY level, pos // 3
        ), runs AS (
          SELECT level, source, pos // 3 AS parent, list(h ORDER BY pos) AS hs FROM trees GROUP BY ALL
        ), head_runs AS (
          SELECT level, pos // 3 AS parent, list(h ORDER BY pos) AS hs FROM heads GROUP BY ALL
        ), way AS (
          SELECT doc_id, source, 0 AS level, pos, changed AS h, '' AS proof FROM leaves
          UNION ALL
          SELECT doc_id, w.source, w.level + 1, w.pos // 3,
            sha256(array_to_string(hs[1 : pos % 3], '') || w.h || array_to_string(hs[pos % 3 + 2 :], '')),
            proof || array_to_string(hs[1 : pos % 3], '') || array_to_string(hs[pos % 3 + 2 :], '')
          FROM way w JOIN runs r ON w.source IS NOT DISTINCT FROM r.source AND w.level = r.level AND w.pos // 3 = parent
            JOIN heights g ON w.source IS NOT DISTINCT FROM g.source WHERE w.level < height
        ), up AS (
          SELECT doc_id, w.source, 0 AS level, s.pos, w.h, proof, s.h AS subroot
          FROM way w JOIN heights g ON w.source IS NOT DISTINCT FROM g.source AND level = height
            JOIN subroots s ON w.source IS NOT DISTINCT FROM s.source
          UNION ALL
          SELECT doc_id, source, u.level + 1, u.pos // 3,
            sha256(array_to_string(hs[1 : pos % 3], '') || u.h || array_to_string(hs[pos % 3 + 2 :], '')),
            proof || array_to_string(hs[1 : pos % 3], '') || array_to_string(hs[pos % 3 + 2 :], ''), subroot
          FROM up u JOIN head_runs r ON u.level = r.level AND u.pos // 3 = parent
          WHERE u.level < (SELECT max(level) FROM heads)
        ), top AS (
          SELECT level, h AS root FROM heads ORDER BY level DESC LIMIT 1
        )
        SELECT l.doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, u.h AS folded_root, u.h = root AS verified
        FROM leaves l JOIN up u ON l.doc_id = u.doc_id JOIN top ON u.level = top.level""",
    "op13_spelling_variants": r"""
        WITH RECURSIVE crc_table AS (
          SELECT list(r ORDER BY i) AS entries FROM (
            SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, _k:
              CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS r FROM range(256) AS t(i))
        ), runs AS (
          SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents
        ), each AS (
          SELECT run, count(*) AS c, hex(encode(doc_id || ':' || run)) AS seed
          FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run
        ), hashed AS (
          SELECT run, c, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
            range(length(seed) // 2), lambda i: CAST('0x' || substr(seed, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))),
            lambda h, b: xor(h // 256, entries[1 + CAST(xor(h % 256, b) AS INTEGER)]))) AS h FROM each, crc_table
        ), words AS (
          SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
            SELECT c, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
              ELSE run END AS word FROM hashed)
          WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2
        ), cut AS (
          SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
          FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
        ), near AS (
          SELECT a.word, b.word AS other, b.n AS other_n
          FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
          UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
          UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word
        ), best AS (
          SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
          FROM near GROUP BY word
        ), forms AS (
          SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form,
            CASE WHEN other_n >= 10 * n THEN other_n END AS form_n FROM words w LEFT JOIN best b ON w.word = b.word
        ), ways AS (
          SELECT word, form AS last, 1 AS step FROM forms WHERE form IS NOT NULL
          UNION ALL
          SELECT w.word, f.form, step + 1 FROM ways w JOIN forms f ON w.last = f.word WHERE f.form IS NOT NULL
        ), ends AS (
          SELECT word, arg_max(last, step) AS root FROM ways GROUP BY word
        )
        SELECT f.word, form, coalesce(root, f.word) AS root, n, n_near, form_n FROM forms f LEFT JOIN ends e ON f.word = e.word""",
}
