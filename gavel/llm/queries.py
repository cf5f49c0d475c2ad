"""The training-data operators as registered queries, one each, over whole tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavel.llm import codes, decontamination, language, linedup, manifest, mixing, neardup, neighbours, repeats, secrets, sharding, tokens, vectordup
from gavel.llm.oracle import ORACLE  # noqa: F401
from gavel.session import table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by pattern and by Markov models."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(secrets.samples(spark, docs)))
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("secrets", lambda s: s["kind"] != "markov")
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("secrets")).alias("spans"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated runs of lines, as a digest."""
    left = linedup.deduplicate_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 byte-balanced contiguous shards."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = sharding.assign_shards(docs, 24, F.col("size"), ties=[F.col("text_crc32")])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings of 200 bytes that start anywhere else too, as a digest."""
    left = repeats.deduplicate_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in 13-word windows of the benchmark."""
    found = decontamination.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    joined = F.array_join("item_ids", ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(joined, 256).alias("items_sha256"), "contaminated")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 2-word shingles are alike by 80 percent or more."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text_key")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed at weights 3, 1, 2 with one and a half times all words."""
    return mixing.mix(table(spark, sf_dir, "documents")).drop("text_md5")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.search(vectors, vectors.filter("vec_id % 100 = 0"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    judged = language.predict(docs.select("doc_id", "text"), language.train(docs))
    return judged.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and tokens within every context limit."""
    return tokens.context_limits(tokens.length_histogram(table(spark, sf_dir, "documents").select("text")))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of all documents, folded again from rows of which a third are tampered with."""
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = manifest.leaf_digest([lowered if f == "text" else F.col(f) for f in fields])
    presented = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, tampered)
    tree = manifest.manifest(docs, fields, carry={"presented": presented})
    tree = tree.withColumn("folded_root", manifest.fold(F.coalesce("presented", "leaf"), F.col("path")))
    return tree.select("doc_id", "leaf", "subroot", "root", F.sha2(manifest.siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of eight parts for every vector, with their errors."""
    coded, books = codes.compress(table(spark, sf_dir, "embeddings"), keep=("label",))
    digest = hashlib.sha256(codes.listed(books).encode()).hexdigest()
    out = codes.label_errors(coded)
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of the vectors of a label whose cosine is 0.93 or more."""
    return vectordup.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))


QUERIES = {"op1_secrets": op1_secrets, "op2_line_dedup": op2_line_dedup, "op3_sharding": op3_sharding, "op4_repeats": op4_repeats, "op5_decontamination": op5_decontamination, "op6_near_duplicates": op6_near_duplicates, "op7_mixing": op7_mixing, "op8_neighbours": op8_neighbours, "op9_language": op9_language, "op10_token_counts": op10_token_counts, "op11_manifest": op11_manifest, "op12_codes": op12_codes, "op13_near_vectors": op13_near_vectors}
