"""From raw documents to packed training sequences.

``STAGES`` are applied in order; each gets what its predecessor kept, as Parquet
in the shared folder, and all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.llm import langid, mixing, packing, simhash_bktree, substring_units
from tabml.llm.queries import small_batches, tokenizer_path
from tabml.llm.store import stored

#: Rows of 20 bytes that are broadcast; a longer list is joined by a shuffle.
BROADCAST_ROWS = 200_000


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` but for the rows named in ``gone`` (row_hash, gone_id)."""
    gone = stored(gone.distinct(), "gone")
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    same = (F.xxhash64(docs.doc_id, docs.text) == gone.row_hash) & docs.doc_id.eqNullSafe(gone.gone_id)
    return docs.join(gone, same, "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: text that fits one better than chance, and enough confidence in it.

    The declared language is ``lang``, the host ``source``. Null and wordless texts go.
    """
    small_batches(spark)
    langs, table = langid.learn(docs, "text", "lang")
    none = F.lit(None).cast("string")
    records = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_hash"), "text", F.col("lang").alias("declared"),
                          none.alias("suffix"), none.alias("domain"), F.col("source").alias("host"))
    judged = langid.identify(records, langs, table)
    return _without(docs, judged.where(~langid.accepted()).select("row_hash", F.col("doc_id").alias("gone_id")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the smallest id (rows without one last), then the smallest hash."""
    small_batches(spark)
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_hash"))
    rows = stored(simhash_bktree.near_duplicates(keyed, shingle=3, radius=3, carry=["row_hash"]), "groups")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_hash")
    first = rows.groupBy("component").agg(F.min(rank).alias("first"))
    named = rows.join(first, "component")
    is_first = (F.col("row_hash") == F.col("first.row_hash")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    kept = _without(docs, named.where(~is_first).select("row_hash", F.col("doc_id").alias("gone_id")))
    again = stored(named.where(is_first).groupBy("row_hash", F.col("doc_id").alias("gone_id")).count().where("count > 1")
                   .select("row_hash", "gone_id"), "equal-rows")
    if again.isEmpty():
        return kept
    same = (F.xxhash64(kept.doc_id, kept.text) == again.row_hash) & kept.doc_id.eqNullSafe(again.gone_id)
    return kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines and sentences that an earlier one holds; those of which nothing is left go."""
    small_batches(spark)
    rows = substring_units.drop_repeats(docs, min_words=5, whole_lines=True, carry=["lang", "source"])
    return (rows.where("text is null or text <> ''")
            .select("doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A mix with the sources weighing 5, 2, 1 in turn, in the order of its shards: blocks of 1,024 words, a row for
    each passage of a document in one."""
    small_batches(spark)
    rows = mixing.shard_texts(docs, mixing.mix(docs, block=1024, shard_slots=1024))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 token ids; a row per piece, with its ids."""
    small_batches(spark)
    return packing.pack(docs, tokenizer_path(), as_list=True)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: Hash fingerprints, seeded draws and token ids have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
