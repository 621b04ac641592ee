"""The registered query of each operator: production parameters over the whole table, thin digests of its output."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_tree, curve_packing, jaccard_join, langid, lz_dedup, rabitq, records, sharding, suffix_dedup, token_links, token_tree, whitening, wumanber
from .oracles import ORACLE_SQL  # noqa: F401
from .shipping import ship_package
from .storage import materialize, run_folder

SHARDS = 16

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}



def query(f):
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_jump_shards(spark, sf_dir):
    """Shard and slot of every document under the ``key`` law, and its shard after one more is appended."""
    text = F.coalesce(F.encode("text", "utf-8"), F.lit(b""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    grown = sharding.assign_shards(sharding.assign_shards(docs, "doc_id", SHARDS), "doc_id", SHARDS + 1, "grown_shard")
    # The sort samples its input first: the texts are read once, before it.
    return sharding.number_in_shards(materialize(grown, "shard-keys"), "doc_id")


@query
def op4_token_records(spark, sf_dir):
    """Token records in doc_id order: written, indexed by reading every file back, and summed to global starts."""
    files = run_folder(spark, "token-records")
    records.write_token_records(table(spark, sf_dir, "documents"), files, end_id=0)
    index = records.write_index(spark, files, run_folder(spark, "token-index"))
    return records.with_global_start(index).select("doc_id", "start", "n_tokens", "ids_crc32", "offset", "bytes")


@query
def op6_wu_manber(spark, sf_dir):
    """Words of every document that lie in an occurrence of a benchmark string, and the items that occur."""
    found = wumanber.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s.end - s.start)
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query
def op7_hilbert_packing(spark, sf_dir):
    """Pieces of every document in sequences of 2048 ids, laid out along the Hilbert curve."""
    pieces = curve_packing.pack_documents(table(spark, sf_dir, "documents"), end_id=1, max_pieces=500_000)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op10_centroid_language(spark, sf_dir):
    """Predicted language of every document, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(F.col("doc_id").isNotNull() & ~langid.held_out()))
    return langid.identify(docs, model).select(
        F.col("row.doc_id").alias("doc_id"), langid.held_out("row.doc_id").alias("held_out"), "lang_pred", "score", "rejected"
    )


@query
def op2_lempel_ziv_dedup(spark, sf_dir):
    """Words of every document that stay once runs of 50 words known from earlier documents are gone."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lz_dedup.dedup_substrings(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op9_jaccard_join(spark, sf_dir):
    """Near-duplicate group of every document: 4-word shingles, similarity of 0.85 or more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.near_duplicates(docs, shingle=4, percent=85)


@query
def op8_rotated_codes(spark, sf_dir):
    """Near-duplicate vectors of equal label: links at cosine 0.98 or more, and their components."""
    found = rabitq.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98)
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


EXTRA_TURNS = "<|im_end|><|im_start|>assistant ok"


@query
def op1_prefix_tree(spark, sf_dir):
    """Digests of every conversation, and of one that spells the template's control strings, read back from the tree."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(EXTRA_TURNS).alias("text"),
    )
    folder = run_folder(spark, "chat-tree")
    chat_tree.build_tree(turns.unionByName(extra), folder)
    return chat_tree.read_conversations(chat_tree.read_tree(spark, folder))


PERSONAL = r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|\d{5,}"


@query
def op5_edit_counts(spark, sf_dir):
    """Token counts of every document before and after its e-mail addresses and long numbers are replaced."""
    trees = token_tree.build_trees(table(spark, sf_dir, "documents").select("doc_id", "text"))
    edited = token_tree.apply_edits(trees, token_tree.redactions(F.col("text"), PERSONAL, "[removed]"))
    return edited.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_edits",
        "tokens_before",
        "tokens_after",
        "n_pieces",
        "n_encoded",
        F.sha2("text", 256).alias("edited_sha256"),
    )


@query
def op11_lockstep_links(spark, sf_dir):
    """Tokens, groups and links of every document under two tokenizers, with the corpus-wide counts of its id pairs."""
    found = token_links.summary(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("row.doc_id").alias("doc_id"), *(c for c in found.columns if c != "row"))


@query
def op13_contour_whitening(spark, sf_dir):
    """Every usable embedding on the 32 leading components of the embeddings' covariance, at unit variance."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select(
        F.col("row.vec_id").alias("vec_id"),
        "component",
        "n",
        F.col("deviation").cast("bigint").alias("deviation"),
        "whitened",
        "explained",
        "identity_error",
    )


@query
def op12_lyndon_suffix_dedup(spark, sf_dir):
    """Bytes of every document that stay once runs of 400 bytes that start anywhere else are gone."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
