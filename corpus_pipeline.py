"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before kept and judges them by themselves. ``run`` writes
every stage's result to the shared folder as Parquet and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stratalith.llm import decontaminate, line_quality, near_dedup, packing, pii
from stratalith.llm.common import few_files, release, settled

SIZE, PERCENT = 5, 80
LENGTH, END_ID = 2048, 1


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and hold enough content lines, with all their columns.

    Each row is judged by its text alone: null and empty texts fail, repeated rows stay or go together. Labels with null ids or
    qualities, or of no document, teach nothing; without labels the base rules decide. An empty table stays empty.
    """
    return line_quality.good_documents(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Documents without words are near nothing and stay. Where ids repeat or are missing, every pair of id
    and text is a document of its own, in the order of ids (missing ones last) and then of the texts'
    hashes; of rows with equal id and text one stays, the first by the JSON text of its other columns. No name of a column clashes.
    An empty table stays empty.
    """
    if docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        groups = near_dedup.near_duplicates(docs, size=SIZE, percent=PERCENT)
        return few_files(docs.join(groups.where("kept").select("doc_id"), "doc_id", "left_semi").select(*docs.columns), 4, 4)
    own = "own"
    while any(c.startswith(own) for c in docs.columns):
        own = f"_{own}"
    own_id, own_sha, own_key, own_number = (f"{own}_{x}" for x in ("id", "sha", "key", "number"))
    sha = F.sha2(F.col("text").cast("binary"), 256)
    keys = docs.select(F.col("doc_id").alias(own_id), sha.alias(own_sha)).distinct().orderBy(F.col(own_id).asc_nulls_last(), own_sha)
    keys = settled(keys.withColumn(own_key, F.monotonically_increasing_id()), "keys")
    keyed = docs.join(keys, F.col("doc_id").eqNullSafe(F.col(own_id)) & sha.eqNullSafe(F.col(own_sha))).select(*docs.columns, own_key)
    groups = near_dedup.near_duplicates(keyed, size=SIZE, percent=PERCENT, id_col=own_key)
    kept = keyed.join(groups.where("kept").select(F.col("doc_id").alias(own_key)), own_key, "left_semi")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    order = F.to_json(F.struct(*others)) if others else F.col(own_key)
    first = F.row_number().over(Window.partitionBy(own_key).orderBy(order))
    return few_files(kept.withColumn(own_number, first).where(f"{own_number} = 1").select(*docs.columns), 4, 4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, with all their columns.

    Null texts and those below five words contain none and stay; so do repeated rows, together. Benchmark rows without text or below
    five words are searched for nowhere. With an empty benchmark all stay; an empty table stays empty.
    """
    return decontaminate.without_leaks(docs, _table(spark, sf_dir, "benchmark"), size=SIZE, percent=PERCENT)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and ``n_chars`` set anew; null texts stay null, with a null count.

    Repeated rows stay repeated, other columns stay as they are, an empty table stays empty.
    """
    return pii.without_personal_data(docs, length_col="n_chars")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of LENGTH ids, as rows of their own.

    A null or empty text is its end id alone, repeated rows are packed each by itself, an empty table gives no pieces.
    """
    import public_tokenizers

    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=END_ID, length=LENGTH)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", sequences),
]

#: Labels, spans and tokens cannot be expressed in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = _table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), f"stage-{name}")
        # Nothing reads the stage before any more.
        release(spark, *before)
        before = [docs]
    return docs
