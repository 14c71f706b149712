"""The queries of the operators, over their whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.llm import exact_dedup, hpyp, interaction, language, licenses, mixing, ngram_join, packing, pii, quality, spelling, urls, wrapper
from riskline.llm.common import in_fold
from riskline.llm.sql import SQL
from riskline.session import ensure_checkpoint_dir

#: Name of the tokenizer file of the packing query, in the folder of public tokenizers.
TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_hpyp_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pitman-Yor language-model scores of every document."""
    return hpyp.scores(table(spark, sf_dir, "documents"))


def op2_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return wrapper.main_text(table(spark, sf_dir, "pages"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by 4-gram Jaccard similarity."""
    return ngram_join.linked_documents(table(spark, sf_dir, "documents"))


def op4_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality features and verdict of every document."""
    return quality.verdicts(table(spark, sf_dir, "documents")).drop("failed_rule")  # its name depends on timings


def op5_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data of every document."""
    return pii.private_spans(table(spark, sf_dir, "documents"))


def op6_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_content_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of every document."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_systematic_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit(language.training_rows(docs))
    return language.identify(docs, model).select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "n_languages")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own or inherited licence of every document."""
    return licenses.scan(licenses.document_files(table(spark, sf_dir, "documents"))).drop("row_key")


def labelled_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, good) of the pages whose document has a label; a page's first all-digit part of the
    path is its document's id.  Good: neither of low quality nor toxic by any label."""
    labels = table(spark, sf_dir, "labels").where("quality is not null or toxic is not null").groupBy("doc_id").agg(
        (~F.coalesce(F.min("quality") == 0, F.lit(False)) & ~F.coalesce(F.max("toxic") == 1, F.lit(False))).alias("good")
    )
    number = F.regexp_extract(urls.path_of(F.col("url")), "/([0-9]+)", 1).try_cast("bigint")
    return table(spark, sf_dir, "pages").select("url", number.alias("doc_id")).join(labels, "doc_id").select("url", "good")


def op11_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url by rules and path templates."""
    return urls.judge(table(spark, sf_dir, "pages"), labelled_urls(spark, sf_dir))


def op12_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove of every source, in all orders."""
    ensure_checkpoint_dir(spark)
    return interaction.audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words one edit apart and their frequent forms, over all documents."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_hpyp_lm, op2_wrapper_induction, op3_ngram_jaccard_join, op4_quality_cascade, op5_weak_supervision_pii, op6_cutting_stock_packing, op7_content_sort_dedup, op8_systematic_mixing, op9_language_mixture, op10_license_scan, op11_url_templates, op12_filter_interaction, op13_spelling_variants)}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in SQL.items() if k in queries()}
