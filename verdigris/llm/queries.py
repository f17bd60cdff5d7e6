"""Registered queries of this subpackage: thin digests of what its operators give."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from verdigris.llm import (
    bpe,
    collocations,
    decontaminate,
    html_extract,
    language_id,
    mixing,
    mtree,
    pu_quality,
    sharding,
    simhash,
    spelling,
    toxicity,
    url_reputation,
)
from verdigris.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


@query("op1_url_reputation", url_reputation.filter_sql())
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A page's outcome is the quality label of the document it shows, by the number in its url."""
    shown = url_reputation.shown_document(F.col("url")).alias("document")
    pages = table(spark, folder, "pages").select("page_id", "url", shown)
    outcomes = table(spark, folder, "labels").select(F.col("doc_id").alias("document"), F.col("quality").alias("good"))
    judged = url_reputation.filter_urls(pages, outcomes, key="document")
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op2_decontaminate")
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, folder, "benchmark"))
    return decontaminate.judge(found).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


@query("op3_language_id")
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = fold("doc_id", 3) == 1
    model = language_id.fit(docs.filter(~held_out), by_prior=True)
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


@query("op4_html_text")
def _(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).select("page_id", "url", "text", "n_chars")


@query("op5_simhash")
def _(spark: SparkSession, folder: str) -> DataFrame:
    linked = simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, radius=3)
    return linked.select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def _scored(scores: DataFrame, held_out) -> DataFrame:
    """(key, score) as doc_id, held_out, score and predicted."""
    return scores.select(
        F.col("key").alias("doc_id"),
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@query("op6_toxicity")
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("key"), "text")
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("key"), F.col("toxic").alias("label"))
    held_out = fold("key", 5) == 0
    return _scored(toxicity.score_toxicity(docs, labels.filter(~held_out)), held_out)


@query("op7_mtree_topk")
def _(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return mtree.top_products(vectors, F.col("vec_id") % 50 == 0, 5)


@query("op8_feistel_sharding")
def _(spark: SparkSession, folder: str) -> DataFrame:
    sized = sharding.describe(table(spark, folder, "documents"))
    placed = sharding.shard_rows(sized, 8, ["doc_id", "text_crc32", "size"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op9_pivotal_mixing")
def _(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, folder, "documents"))
    return plan.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
    )


@query("op10_pu_quality")
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("key"), "text")
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("key"), "quality")
    held_out = fold("key", 3) == 1
    positives = labels.filter(~held_out & (F.col("quality") == 1)).select("key")
    return _scored(pu_quality.score_quality(docs, positives), held_out)


@query("op11_bpe")
def _(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    vocabulary = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    both = bpe.decode(bpe.encode(docs, vocabulary, packed=True), vocabulary)
    return both.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op12_collocations", collocations.mine_sql())
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("lang", "text")
    return collocations.mine(collocations.count_phrases(docs))


@query("op13_spelling_variants")
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return spelling.group_variants(spelling.count_words(docs)).select(
        "word", "form", "root", "n", "n_near", "form_n"
    )
