"""The queries opN of the training-data operators, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from entigrid.llm import (
    circulant, decontaminate, jaccard_join, minhash, packing, prefix_trie, secret_scan, sharding, spelling, substring_dedup, toxicity,
    warc, wavelet,
)
from entigrid.llm.common import stored, table
from entigrid.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    compared = stored(minhash.compared_with_edits(docs), "compared")
    hexed = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return minhash.with_clusters(compared.withColumns(hexed).drop("n"), minhash.near_duplicates(docs, marked=compared))


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.with_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), "found")
    counts = [F.expr(f"CAST(size(filter(found, x -> x.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in secret_scan.BASE]
    base = secret_scan.spans_text("found", secret_scan.BASE)
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), secret_scan.spans_text("found").alias("spans"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    spans = F.expr("array_join(transform(sequence(0, size(r.spans) DIV 2 - 1), i -> concat(r.spans[2 * i], ':', r.spans[2 * i + 1])), ',')")
    return toxicity.with_scores(docs, model, "r").select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        F.col("r.score").alias("score"),
        (F.col("r.score") >= toxicity.REJECT).cast("int").alias("predicted"),
        F.when(F.size("r.spans") > 0, spans).otherwise("").alias("spans"),
    )


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(packing.pieces(table(spark, sf_dir, "documents"), with_ids=False))


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(table(spark, sf_dir, "documents"))


@query
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.assigned(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "bytes", "shard", "depth", "part")


@query
def op9_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = wavelet.write_shards(table(spark, sf_dir, "documents"), scratch_path(spark, "wavelet"))
    return wavelet.read_shards(spark, path)


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.with_hits(docs, table(spark, sf_dir, "benchmark"), "hits")
    return found.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        decontaminate.n_hit("hits").alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
        (F.size("hits.spans") > 0).alias("contaminated"),
    )


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query
def op12_circulant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant.near_components(table(spark, sf_dir, "documents"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.sequences(prefix_trie.rebuilt(table(spark, sf_dir, "conversations"))))
