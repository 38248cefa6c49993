"""The training-data pipeline over ``documents``.

Each stage reads what its predecessor wrote, so a lost executor costs a part of one
stage. All but the last return the columns of ``documents``; ``run`` returns the rows of
the last.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearmiss.llm.common import ensure_checkpoint_dir, table
from nearmiss.llm.jaccard_join import near_duplicates
from nearmiss.llm.mixing import PULL, draws, mix, quality_domains
from nearmiss.llm.packing import pack_documents
from nearmiss.llm.quality_lines import keep_content, train_field
from nearmiss.llm.queries import DOMAIN_WEIGHTS, SEQUENCE_TOKENS
from nearmiss.llm.suffix_dedup import remove_repeats

#: The stages hold trained models and numpy kernels, which SQL can't express.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are mostly content lines."""
    return keep_content(docs, train_field(docs, table(spark, sf_dir, "labels")))


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id.

    Five-word shingles, similarity 0.8. Rows that share an id but not the text are told apart by
    their sets: of a group's smallest id the smallest set stays, and of texts of one set one.
    Rows without an id link with none that has one; of those with equal sets one stays. Texts
    without words stay, one of each id and text.
    """
    groups = near_duplicates(docs, width=5, percent=80, with_sets=True)
    heads = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("set_id").eqNullSafe(F.col("head_set_id")))
    blank = F.when(F.col("set_id").isNull(), F.col("text_hash"))
    stay = heads.groupBy("doc_id", "set_id", blank.alias("blank")).agg(F.min("text_hash").alias("_text"))
    # null ids as keys that can be joined
    keys = {"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "_null": F.col("doc_id").isNull()}
    stay = stay.withColumns(keys).select(*keys, "_text")
    named = docs.withColumns({**keys, "_text": F.xxhash64(F.col("text").cast("string"))})
    return named.join(stay, [*keys, "_text"], "left_semi").dropDuplicates([*keys, "_text"]).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur more than once. A character is cut only if all its
    bytes are, and ``n_chars`` counts what is left. Null texts become empty; all rows stay."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    left = remove_repeats(docs, with_text=True, whole_characters=True, carry=others)
    text = F.decode("kept", "UTF-8")
    rows = left.select(
        "doc_id", text.alias("text"), *(F.col(f"_carry_{c}").alias(c) for c in others)
    )
    kind = docs.schema["n_chars"].dataType
    return rows.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say, so that the domains meet their target weights."""
    names = tuple(c for c in docs.columns if c != "doc_id")
    rates, _ = mix(docs, quality_domains(table(spark, sf_dir, "labels")), DOMAIN_WEIGHTS, pull=PULL, carry=names)
    times = draws(F.col("rate"), "doc_id", "_carry_text")
    taken = rates.select("*", F.explode(F.array_repeat(F.lit(True), times)).alias("taken"))
    return taken.select("doc_id", *(F.col(f"_carry_{c}").alias(c) for c in names)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, with their places in sequences."""
    return pack_documents(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
        {"<|endoftext|>": 50256}, end_id=0, size=SEQUENCE_TOKENS,
    )


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicate_groups),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
