"""Registered queries of the numbered operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    infill,
    language,
    lines,
    main_text,
    packing,
    pii,
    quality,
    repeats,
    sentence_pieces,
    shingle_join,
    token_counts,
    vectors,
    whitening,
)
from .shipping import ship_package

#: A vocabulary file's name -> its path; the files are never part of the library.
PIECE_MODEL, BYTE_MODEL = "piece_bpe_32k.model", "byte_bpe_50k.json"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return sentence_pieces.round_trip(docs, vocabulary(PIECE_MODEL))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(_read(spark, sf_dir, "documents"))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_digest(_read(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(_read(spark, sf_dir, "documents"), vocabulary(BYTE_MODEL))


def op5_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.link_shingles(_read(spark, sf_dir, "documents"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_main_text(_read(spark, sf_dir, "pages"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_languages(_read(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess_quality(_read(spark, sf_dir, "documents"))


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.link_vectors(_read(spark, sf_dir, "embeddings"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.over_limit(_read(spark, sf_dir, "documents"), vocabulary(BYTE_MODEL))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_vectors(_read(spark, sf_dir, "embeddings"))


def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.lines_digest(_read(spark, sf_dir, "documents"))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.infill_digest(_read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sentence_pieces": op1_sentence_pieces,
        "op2_pii": op2_pii,
        "op3_repeats": op3_repeats,
        "op4_packing": op4_packing,
        "op5_shingle_join": op5_shingle_join,
        "op6_main_text": op6_main_text,
        "op7_language": op7_language,
        "op8_quality": op8_quality,
        "op9_vectors": op9_vectors,
        "op10_token_counts": op10_token_counts,
        "op11_whitening": op11_whitening,
        "op12_lines": op12_lines,
        "op13_infill": op13_infill,
    }


def oracle_sql() -> dict[str, str]:
    return {"op12_lines": lines.LINES_SQL, "op13_infill": infill.INFILL_SQL}
