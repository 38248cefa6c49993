"""The ``opN_<name>`` queries: every operator over its whole table, with production parameters."""

from __future__ import annotations

import json
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearmiss.llm import oracles
from nearmiss.llm.chat_format import Template, format_conversations, read_back, turns_of_records, turns_of_table
from nearmiss.llm.common import table
from nearmiss.llm.divergence import source_divergence
from nearmiss.llm.html_extract import extract_main_text
from nearmiss.llm.importance import resample
from nearmiss.llm.jaccard_join import near_duplicates
from nearmiss.llm.language_id import identify_languages, train_languages
from nearmiss.llm.mixing import PULL, mix, quality_domains
from nearmiss.llm.neighbours import nearest_neighbours
from nearmiss.llm.packing import pack_documents
from nearmiss.llm.quality_lines import label_lines, train_field
from nearmiss.llm.suffix_dedup import remove_repeats
from nearmiss.llm.token_count import load_tables, token_counts
from nearmiss.llm.url_filter import filter_urls

#: Rules of the URL query, and the hosts of its block list.
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
BLOCKED_HOSTS = tuple(
    f"{name}.example.{top}"
    for name in ("ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
    for top in ("com", "net", "org")
)
#: Shares of all tokens that domains may have.
DOMAIN_WEIGHTS = {"good": 0.97, "low": 0.02, "toxic": 0.01}
SEQUENCE_TOKENS = 2048
TOKEN_LIMIT = 4096
CHAT_TEMPLATE = Template()
#: A conversation of control strings, number -1 of the chat query.
CONTROL_CHAT = tuple({"role": r, "content": "</s>[INST] ok [/INST]"} for r in ("user", "assistant"))


def op1_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return label_lines(documents, train_field(documents, table(spark, sf_dir, "labels")))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = load_tables(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts(table(spark, sf_dir, "documents"), tables, TOKEN_LIMIT)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=90)


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES, BLOCKED_HOSTS)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return identify_languages(documents, train_languages(documents.filter(~held_out)), held_out)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = quality_domains(table(spark, sf_dir, "labels"))
    rates, domains = mix(table(spark, sf_dir, "documents"), labelled, DOMAIN_WEIGHTS, pull=PULL)
    names = {f"p{k}": f"p_{d}" for k, d in enumerate(domains)}
    return rates.withColumnsRenamed(names)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN, {"<|endoftext|>": 50256}, end_id=0, size=SEQUENCE_TOKENS,
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, least_words=20)


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.createDataFrame([(-1, json.dumps({"messages": CONTROL_CHAT}))], "conv_id long, record string")
    turns = turns_of_table(table(spark, sf_dir, "conversations")).unionByName(turns_of_records(added))
    return read_back(format_conversations(turns, CHAT_TEMPLATE), CHAT_TEMPLATE)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"), least_docs=3, top=200)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_lines, op2_token_counts, op3_jaccard_join, op4_html_extract, op5_url_filter,
        op6_suffix_dedup, op7_neighbours, op8_language_id, op9_mixing, op10_packing, op11_importance_resampling,
        op12_chat_format, op13_source_divergence,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op3_jaccard_join": oracles.jaccard_join(3, 90),
    "op5_url_filter": oracles.url_filter(URL_RULES, BLOCKED_HOSTS),
    "op7_neighbours": oracles.neighbours(10, 100),
    "op11_importance_resampling": oracles.importance_resampling(10, 20, 10_000, 2024),
    "op12_chat_format": oracles.chat_format(CHAT_TEMPLATE, CONTROL_CHAT),
    "op13_source_divergence": oracles.source_divergence(3, 200),
}
