"""One query per operator over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cws, fim, html_layout, langid, mixing, packing, pstable, qda, simhash_bktree, substring_units, suffix_refine, suffix_search, whitening


def small_batches(spark: SparkSession) -> None:
    """Fewer rows in an Arrow batch than Spark's 10,000, as a row is a whole text: less memory in JVM and Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens; a row per piece."""
    pieces = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate groups of all documents: 3-word shingles, 3 bits."""
    rows = simhash_bktree.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All visible text of all pages, laid out."""
    rows = html_layout.extract_text(_table(spark, sf_dir, "pages"), carry=["url"])
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines and sentences that an earlier one holds."""
    rows = substring_units.drop_repeats(_table(spark, sf_dir, "documents"), min_words=5, whole_lines=True)
    return rows.select("doc_id", "text", "kept", "removed", F.size("removed").cast("long").alias("n_removed"),
                       F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s.end - s.start).alias("removed_chars"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted-sampling fingerprints of all documents and of their edited texts."""
    return cws.fingerprint_edits(_table(spark, sf_dir, "documents"), samples=64)


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings: equal label, cosine of 0.98 or more."""
    return pstable.near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents that strings of 400 bytes occurring elsewhere cover; the removed spans, and the text that is
    left (null where a cut falls inside a character)."""
    rows = suffix_refine.remove_repeats(_table(spark, sf_dir, "documents"), length=400)
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                       F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
                       "removed", F.try_validate_utf8(F.col("kept").cast("string")).alias("text"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all pages (markup language, address) and all documents (lang and source in their place)."""
    docs, pages = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages")
    langs, table = langid.learn(docs, "text", "lang")
    host, domain, suffix = langid.host_parts(F.col("url"))
    texts = html_layout.extract_text(pages.withColumns({"declared": langid.declared_language(F.col("html")), "suffix": suffix, "domain": domain, "host": host}),
                                     carry=["declared", "suffix", "domain", "host"])
    records = (texts.withColumn("doc_id", F.lit(None).cast("long"))
               .unionByName(docs.select(F.lit(None).cast("long").alias("page_id"), "doc_id", "text", F.col("lang").alias("declared"),
                                        F.lit(None).cast("string").alias("suffix"), F.lit(None).cast("string").alias("domain"), F.col("source").alias("host"))))
    return langid.identify(records, langs, table).withColumn("accepted", langid.accepted())


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from labels.quality outside the held-out fold."""
    return qda.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all documents, sources weighing 5, 2, 1 in turn, takes of each."""
    rows = mixing.mix(_table(spark, sf_dir, "documents")).documents
    return rows.select("doc_id", "size", "source_size", "target", "taken", "source")


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as prefix, suffix and middle, cut at line ranks; digests of the output and of the text rebuilt from it."""
    rows = fim.fill_in_middle(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents inside 10-word windows of the benchmark, and the items these are from."""
    rows = suffix_search.find_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    rows = rows.withColumn("n_hit", suffix_search.n_hit())
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
                       F.coalesce(F.array_max(F.transform("matches", lambda m: m.words)), F.lit(0)).cast("long").alias("longest_match"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened on their eight leading components."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=8)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_simhash": op2_simhash,
    "op3_html_text": op3_html_text,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_fingerprints": op5_fingerprints,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_language_id": op8_language_id,
    "op9_quality": op9_quality,
    "op10_mixing": op10_mixing,
    "op11_fim": op11_fim,
    "op12_decontamination": op12_decontamination,
    "op13_whitening": op13_whitening,
}

#: For operators whose result SQL can state: the cuts follow from a hash of the id, the passages from a join of all windows.
SQL: dict[str, str] = {
    "op11_fim": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (
  SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines,
    ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (
  SELECT *, len(lines)::BIGINT AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a, greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT *, array_to_string(lines[1:a], '') AS prefix, array_to_string(lines[a + 1:b], '') AS middle, array_to_string(lines[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p
""",
    "op12_decontamination": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
q AS (
  SELECT item_id, least(10, len(w)) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i, w FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, i AS item_at, array_to_string(w[i:i + k - 1], ' ') AS gram FROM q),
lengths AS (SELECT DISTINCT k FROM windows),
places AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
grams AS (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS gram FROM places, lengths WHERE i + k - 1 <= len(w)),
found AS (SELECT r, i, k, item_id, item_at FROM grams JOIN windows USING (k, gram)),
hit AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + k)) AS at FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r),
runs AS (SELECT r, item_id, item_at - i AS diagonal, i, k, i - row_number() OVER (PARTITION BY r, item_id, k, item_at - i ORDER BY i) AS run FROM found),
longest AS (SELECT r, max(n) AS longest FROM (SELECT r, max(i + k) - min(i) AS n FROM runs GROUP BY r, item_id, diagonal, run, k) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(longest, 0)::BIGINT AS longest_match
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r) LEFT JOIN longest USING (r)
""",
}
