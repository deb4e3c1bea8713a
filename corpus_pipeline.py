"""The corpus pipeline: quality, near duplicates, decontamination, secrets, packing.

Every stage takes the documents that its predecessor kept. ``run`` writes each stage's rows as
Parquet in the session's shared folder, reads them again for the next and deletes what each stage
made for itself; in the end only the last stage's rows are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from phrasemill.llm import decontaminate, minhash, packing, quality, secrets
from phrasemill.llm.common import Scope, discard, stored, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance sample holds, all columns.

    Null and empty texts have weight 0 and are sampled as such; long texts are weighed whole; repeated rows stay or go
    together, as do rows that tie at the k-th key; without documents there are none, without labels of both kinds
    all stay; columns that share a name with the operator's own keep their values.
    """
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard similarity 0.8 or more): its smallest doc_id.

    Null and wordless texts are copies of each other; long texts are compared whole; of repeated rows one stays; a null
    doc_id stays only where its group has no other; no documents give none; clashing columns keep their values.
    """
    return minhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window.

    Null and wordless texts have none and stay; long texts are scanned whole; repeated rows stay or go together; without
    benchmark items all stay; no documents give none; clashing columns keep their values.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with secrets blanked; n_chars follows the text.

    Null text stays null; long texts are scanned whole; spans that start together are blanked as the first kind; repeated
    rows stay; no documents give none; other columns keep their values.
    """
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens, placed in sequences.

    Null text is the end id alone; long texts are cut into full pieces and a rest; repeated rows and null doc_ids are packed
    as rows of their own; no documents give no pieces; other columns are ignored.
    """
    return packing.pack(docs)


STAGES = [("quality", classify), ("near_dedup", near_dedup), ("decontaminate", decontaminated), ("secrets", without_secrets), ("pack", packed)]

#: Classifier sampling, near copies and tokenizers have no DuckDB form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    with Scope(spark) as whole:
        for name, stage in STAGES:
            with Scope(spark) as made:
                docs = made.keep(stored(stage(spark, docs, sf_dir), f"pipeline-{name}"))
            if before is not None:
                discard(before)
            before = docs
        return whole.keep(docs)
