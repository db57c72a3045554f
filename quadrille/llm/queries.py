"""The operators as queries over whole tables, each next to its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage, staged_path
from . import sql
from .collocations import mine_phrases
from .common import ascii_lower
from .exact_dedup import exact_dedup
from .genetic_packing import pack_genetically
from .language_id import identify
from .line_dedup import find_line_copies
from .merkle import audit
from .minhash import near_duplicates
from .mixing import mix_documents
from .packing import pack_documents
from .quality_rules import judge_quality
from .secret_scans import scan_secrets
from .sharding import assign_shards, write_shards
from .url_filters import Rule, judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

RULES = [
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
]
SHARDS = [f"shard-{i:03d}" for i in range(256)]


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    if fn.__name__ in sql.ORACLES:
        SQL[fn.__name__] = sql.ORACLES[fn.__name__]
    return fn


@_query
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding entry and verdict of every page's URL."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


@_query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every line of every document, and whether it is the first of its class."""
    return find_line_copies(_read(spark, sf_dir, "documents"))


@_query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts."""
    return exact_dedup(_read(spark, sf_dir, "documents"))


@_query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return pack_documents(_read(spark, sf_dir, "documents"), tokenizer_path())


@_query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return identify(_read(spark, sf_dir, "documents"))


@_query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    mixed = mix_documents(_read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@_query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents placed in a folder per shard, then read back: shard of every document, with all its columns but
    the text, of which there are the length and a digest, and the bytes of text in its shard."""
    docs = _read(spark, sf_dir, "documents")
    placed = assign_shards(docs, ["doc_id"], SHARDS).withColumn("slot", F.col("slot").cast("bigint"))
    path = staged_path(spark)
    write_shards(placed, path)
    back = spark.read.schema(placed.schema).parquet(path)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    sizes = stage(back.groupBy("shard").agg(F.sum(size).alias("shard_bytes")))
    columns = ["doc_id", "lang", "source", "n_chars", "slot", "shard"]
    said = back.select(*columns, size.alias("text_bytes"), F.md5("text").alias("text_md5"))
    return said.join(sizes, "shard").select(*columns, "text_bytes", "text_md5", "shard_bytes")


@_query
def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    return scan_secrets(_read(spark, sf_dir, "documents"))


@_query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return judge_quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


@_query
def quality_rules_on_few_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same at a risk of a fifth, for which the labels of small tables suffice."""
    return judge_quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), risk=0.2)


@_query
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates of every document."""
    return near_duplicates(_read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@_query
def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in as few sequences of 1024 tokens as the islands find."""
    return pack_genetically(_read(spark, sf_dir, "documents"), tokenizer_path())


@_query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language."""
    return mine_phrases(_read(spark, sf_dir, "documents"))


@_query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether it verifies after a fifth were lower-cased."""
    fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.when(fifth, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    return audit(_read(spark, sf_dir, "documents"), {"text": lowered})
