"""One query per operator, with production parameters, over the whole intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docloom.llm._common import table


def _tokenizer() -> str:
    import public_tokenizers

    from docloom.llm.tokens import TOKENIZER

    return public_tokenizers.path(TOKENIZER)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.warc import round_trip

    return round_trip(table(spark, sf_dir, "pages"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), _tokenizer(), with_ids=False)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.substring_dedup import dedup_report

    return dedup_report(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.tokens import token_counts

    return token_counts(table(spark, sf_dir, "documents"), _tokenizer())


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.near_dup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.ann import search

    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 20 = 0"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.html_text import main_text

    return main_text(table(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.decontamination import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.sharding import shard_rows

    return shard_rows(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from docloom.llm.alignment import PIECES, alignment

    return alignment(table(spark, sf_dir, "documents"), _tokenizer(), public_tokenizers.path(PIECES))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.fim import digests

    return digests(table(spark, sf_dir, "documents"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.group_join import jaccard_join

    return jaccard_join(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_warc, op2_packing, op3_toxicity, op4_substring_dedup, op5_token_counts, op6_near_dup, op7_ann, op8_html_text, op9_decontamination, op10_sharding, op11_alignment, op12_fill_in_middle, op13_jaccard_join)}


def oracle_sql() -> dict[str, str]:
    from docloom.llm.fim import SQL

    return {"op12_fill_in_middle": SQL}
