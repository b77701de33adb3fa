"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from stratalith.llm.decontaminate import leaks
from stratalith.llm.fill_in_middle import fill_in_middle, restored
from stratalith.llm.language import languages, prototypes
from stratalith.llm.line_quality import line_quality
from stratalith.llm.near_dedup import near_duplicates
from stratalith.llm.packing import packed
from stratalith.llm.pair_index import encoded
from stratalith.llm.pii import personal_data
from stratalith.llm.suffix_dedup import repeated_bytes
from stratalith.llm.token_alignment import aligned
from stratalith.llm.token_counts import token_counts
from stratalith.llm.token_files import read_token_files, write_token_files
from stratalith.llm.warc_zip import archived


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    """The path of a public tokenizer's description."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), size=5, percent=80)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)))
    known = prototypes(docs.where("not held_out"))
    return languages(docs, known, extra=("held_out",))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = write_token_files(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), end_id=2)
    return read_token_files(spark, folder, manifest)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), size=3, percent=85)


def op5_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(_table(spark, sf_dir, "pages")).drop("url")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(_table(spark, sf_dir, "documents")).drop("base_spans")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), limit=2048)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(_table(spark, sf_dir, "documents")).drop("spans")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), end_id=1, length=2048)


def op10_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encoded(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), decode=True)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = restored(fill_in_middle(_table(spark, sf_dir, "documents")))
    digests = [F.sha2(F.col(x).cast("binary"), 256).alias(f"{x}_sha256") for x in ("output", "restored")]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_language_id": op2_language_id,
    "op3_token_files": op3_token_files,
    "op4_near_dedup": op4_near_dedup,
    "op5_warc_zip": op5_warc_zip,
    "op6_personal_data": op6_personal_data,
    "op7_token_counts": op7_token_counts,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_packing": op9_packing,
    "op10_line_quality": op10_line_quality,
    "op11_bpe_round_trip": op11_bpe_round_trip,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_token_alignment": op13_token_alignment,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}),
    # Words are lower-cased runs of ASCII letters, digits and everything beyond ASCII.
    "op1_decontaminate": r"""
WITH texts AS (
    SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), words AS (
    SELECT side, id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-/:-@\[-`{-\x7F]+') AS w FROM texts
), shingles AS (
    SELECT DISTINCT side, id, w[k:k + 4] AS s FROM (SELECT side, id, w, unnest(range(1, len(w) - 3)) AS k FROM words WHERE len(w) >= 5)
), sizes AS (
    SELECT id, count(*) AS n FROM shingles WHERE side = 1 GROUP BY id
), shared AS (
    SELECT d.id AS doc_id, i.id AS item_id, count(*) AS c
    FROM (SELECT * FROM shingles WHERE side = 1) i JOIN (SELECT * FROM shingles WHERE side = 0) d ON i.s = d.s
    GROUP BY ALL
)
SELECT doc_id, item_id, n AS item_shingles, c AS shared_shingles, c / n::DOUBLE AS containment
FROM shared JOIN sizes ON sizes.id = shared.item_id WHERE 100 * c >= 80 * n
""",
    # Shingles are lists of words; a document with fewer than three words is one shingle.
    "op4_near_dedup": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, w[k:k + 2] AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS k FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT p.a, p.b
    FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL) p
    JOIN sizes i ON i.doc_id = p.a JOIN sizes j ON j.doc_id = p.b
    WHERE 100 * p.shared >= 85 * (i.n + j.n - p.shared)
), reach AS (
    SELECT doc_id AS d, doc_id AS r FROM documents
    UNION
    SELECT reach.d, links.b FROM reach JOIN links ON links.a = reach.r
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN (SELECT d AS doc_id, min(r) AS component_id FROM reach GROUP BY d) c USING (doc_id)
""",
    "op5_warc_zip": r"""
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), digests AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM payloads
), chiefs AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS chief FROM digests
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 1000 AND page_id <> chief THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id <> chief THEN chief END AS refers_to
FROM chiefs
""",
    # Draws are the first digits of a hash of the id; texts are cut after code points.
    "op12_fill_in_middle": r"""
WITH digests AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS h FROM documents
), draws AS (
    SELECT doc_id, t, length(t) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
    FROM digests
), cuts AS (
    SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS c, greatest(h1 % (n + 1), h2 % (n + 1)) AS d,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM draws
), parts AS (
    SELECT *, substring(t, 1, c) AS prefix, substring(t, c + 1, d - c) AS middle, substring(t, d + 1, n - d) AS suffix FROM cuts
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN c::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN (d - c)::BIGINT END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts
""",
}
