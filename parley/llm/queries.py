"""The corpus operators' registered queries; each covers its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, common, divergence, langid, license, media, packing, pages, quality, sentencepieces, simhash, suffix, target, tokenfile


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(common.table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(common.table(spark, sf_dir, "documents"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(common.table(spark, sf_dir, "embeddings"))


def op5_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(common.table(spark, sf_dir, "documents"))


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    path = common.shared_dir(spark, "tokens")
    manifest = tokenfile.write_tokens(docs, path, tokenizer_path(), end_id=2)
    return tokenfile.read_tokens(manifest, path)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.table(spark, sf_dir, "documents"), tokenizer_path())


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return media.media_features(common.stored(media.with_media(docs), "media"))


def op9_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(common.table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.digest(common.table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op11_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target.resample(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def op12_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(common.table(spark, sf_dir, "pages"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(common.table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_language": op2_language,
    "op3_simhash": op3_simhash,
    "op4_neighbours": op4_neighbours,
    "op5_suffix": op5_suffix,
    "op6_token_output": op6_token_output,
    "op7_packing": op7_packing,
    "op8_media": op8_media,
    "op9_license": op9_license,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_target": op11_target,
    "op12_pages": op12_pages,
    "op13_divergence": op13_divergence,
}

ORACLE_SQL: dict[str, str] = {"op9_license": license.oracle(), "op11_target": target.oracle(), "op13_divergence": divergence.oracle()}
