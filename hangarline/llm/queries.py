"""Each operator over its whole table with its production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hangarline.llm import (
    exact_dedup,
    html,
    language,
    lexical,
    licenses,
    merkle,
    mixing,
    packing,
    pii,
    quality,
    simhash,
    topk,
    toxicity,
)
from hangarline.llm.common import ship_package

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _op1(documents: DataFrame) -> DataFrame:
    return exact_dedup.exact_duplicates(documents)


def _op2(documents: DataFrame) -> DataFrame:
    return packing.pack(documents, TOKENIZER)


def _op6(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return mixing.mixed(documents, mixing.domain_labels(labels)).drop("own")


def _op8(documents: DataFrame) -> DataFrame:
    return licenses.license_scan(documents).drop("spans")


_QUERIES: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "op1_exact_dedup": (_op1, ("documents",)),
    "op2_packing": (_op2, ("documents",)),
    "op3_quality": (quality.quality_scores, ("documents", "labels")),
    "op4_topk": (topk.embedding_neighbours, ("embeddings",)),
    "op5_main_text": (html.main_texts, ("pages",)),
    "op6_mixing": (_op6, ("documents", "labels")),
    "op7_toxicity": (toxicity.toxicity, ("documents", "labels")),
    "op8_licenses": (_op8, ("documents",)),
    "op9_simhash": (simhash.near_duplicates, ("documents",)),
    "op10_language": (language.identify, ("documents",)),
    "op11_lexical": (lexical.search, ("documents", "benchmark")),
    "op12_pii": (pii.personal_data, ("documents",)),
    "op13_manifest": (merkle.tampered_manifest, ("documents",)),
}


def _over_tables(operator: Callable[..., DataFrame], tables: tuple[str, ...]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return operator(*[spark.read.parquet(f"{sf_dir}/{table}.parquet") for table in tables])

    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _over_tables(operator, tables) for name, (operator, tables) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": exact_dedup.ORACLE,
        "op4_topk": topk.ORACLE,
        "op11_lexical": lexical.ORACLE,
        "op12_pii": pii.ORACLE,
        "op13_manifest": merkle.ORACLE,
    }
