"""The registered queries ``opN_<name>`` and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm import alignment, decontam, embeddings, html, lm, packing, pii, quality, secrets, simhash, spans, trie, urls
from lakeops.llm.common import load

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and near-duplicate group."""
    rows = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return rows.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its secret spans."""
    return secrets.secret_report(load(spark, sf_dir, "documents"))


ORACLE["op2_secret_scan"] = secrets.oracle_sql()


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its counts and the verdict of the rules."""
    return quality.quality_rules(load(spark, sf_dir, "documents"))


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with the rule and verdict of its url."""
    pages = load(spark, sf_dir, "pages")
    return urls.url_verdicts(pages.select("page_id", "url"), urls.listed_hosts(pages)).select("page_id", "host", "path", "rule", "verdict")


ORACLE["op5_url_filter"] = urls.oracle_sql()


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items it holds."""
    return decontam.decontaminate(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")).drop("text_hash")


ORACLE["op7_decontamination"] = decontam.oracle_sql()


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that stand elsewhere before."""
    return spans.drop_repeats(load(spark, sf_dir, "documents"))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    return packing.pack(load(spark, sf_dir, "documents"))


@query
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its spans of personal data."""
    return pii.personal_data(load(spark, sf_dir, "documents"))


@query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its masked pseudo-likelihood."""
    return lm.pseudo_likelihood(load(spark, sf_dir, "documents"))


@query
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its main text."""
    return html.extract(load(spark, sf_dir, "pages"))


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return trie.rebuilt_trie(load(spark, sf_dir, "conversations"))


ORACLE["op13_conversation_trie"] = trie.oracle_sql()


@query
def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its near-duplicate links and group."""
    return embeddings.near_vectors(load(spark, sf_dir, "embeddings"))


ORACLE["op12_embedding_near_dedup"] = embeddings.oracle_sql()


@query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the groups and links of its tokens on both sides."""
    return alignment.token_alignment(load(spark, sf_dir, "documents"))[0]
