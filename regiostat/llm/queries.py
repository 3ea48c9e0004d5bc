"""The registered queries ``opN_<name>``: each applies its operator with
production parameters to a whole table and derives the agreed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat.llm.common import crc_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Where the public vocabularies lie; a parameter of ``token_counts``.
VOCABULARY = "byte_bpe_50k.json"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from regiostat.llm.lm_scoring import lm_scores
    held_out = crc_mod(F.col("doc_id"), 7) == 2
    scored = lm_scores(table(spark, sf_dir, "documents"), learn=~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from regiostat.llm.quality_rules import quality
    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "bad_chunks")


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from regiostat.llm import toxicity
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = toxicity.train(docs, labels, learn=crc_mod(F.col("doc_id"), 3) != 1)
    return toxicity.score(docs, machine).select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                                                (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from regiostat.llm.token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), limit=512)


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from regiostat.llm.decontamination import decontaminate
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10, k=5)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from regiostat.llm.near_duplicates import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from regiostat.llm.secret_scan import digest, scan
    return digest(scan(table(spark, sf_dir, "documents")))


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from regiostat.llm.pii import digest, scan
    return digest(scan(table(spark, sf_dir, "documents")))


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from regiostat.llm.mixing import mix
    return mix(table(spark, sf_dir, "documents"))


@query
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from regiostat.llm import html_extraction
    pages = table(spark, sf_dir, "pages")
    found = html_extraction.extract(pages, html_extraction.train(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from regiostat.llm.conversation_trie import trie
    return trie(table(spark, sf_dir, "conversations"), every=20, most=4)


@query
def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from regiostat.llm.url_filter import Rule, filter_urls
    rules = [Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/")]
    return filter_urls(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict", "score")


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from regiostat.llm.spelling_variants import variants
    return variants(table(spark, sf_dir, "documents"), typo_every=97, least_length=5, least_count=3, ratio=2)


def _oracles() -> None:
    from regiostat.llm import conversation_trie, mixing, pii, secret_scan, spelling_variants
    ORACLE["op13_spelling_variants"] = spelling_variants.oracle()
    ORACLE["op11_conversation_trie"] = conversation_trie.oracle()
    ORACLE["op3_mixing"] = mixing.oracle()
    ORACLE["op2_secret_scan"] = secret_scan.oracle()
    ORACLE["op10_pii"] = pii.oracle()


_oracles()
