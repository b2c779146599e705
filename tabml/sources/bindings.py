"""Bindings of the library to the driver tables.

The reference works on one labelled table with numeric features and a binary
label. The driver ships TPC-H-like tables, so the labelled inputs are derived
views of ``lineitem``:

* ``feat``      id, h (seeded md5 of id), 4 numeric features, binary label
* ``feat_raw``  same rows with real gaps (zero discount / tax -> NULL) and a
                text class (R -> 1, A -> 0, anything else -> NULL)
* ``dup_view``  a heavily duplicated projection (de-duplication input)
* ``preds``     long prediction table (model, id, split, label, score,
                prediction) of fixed, SQL-expressible scorecards. They stand in
                for trained models so that every evaluation operator can be
                checked against SQL; trained MLlib models produce the same
                table shape (see ``tabml.plans.train``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.functions.exprs import md5_key
from tabml.operators.split import split_and_folds
from tabml.sources.cache import held
from tabml.sources.tables import read_table

SEED = 42
FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ID_PARTS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
# The derived label: revenue of the line above one million.
LABEL_THRESHOLD = 1_000_000

# Scorecards: (model, training_time seconds). training_time is a fixed stand-in
# (wall time is not deterministic, so it never enters a SQL-compared column).
SCORECARDS = [("price", 0.8), ("quantity", 0.3), ("blend", 1.1), ("hard", 0.05)]


def _id_expr():
    parts = [F.col(c).cast("string") for c in ID_PARTS]
    parts.append(F.col("l_quantity").cast("int").cast("string"))
    return F.concat_ws("|", *parts)


def feat(spark: SparkSession, sf_dir: str, extra=()) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ID_PARTS + FEATURES + list(extra))
    return feat_from_lineitem(li, extra)


def feat_from_lineitem(li: DataFrame, extra=()) -> DataFrame:
    """The feat derivation alone: stateless, so it also runs on a stream."""
    revenue = F.col("l_quantity") * F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))
    return (li.withColumn("id", _id_expr())
              .withColumn("h", md5_key("id", seed=SEED))
              .withColumn("label", (revenue > F.lit(LABEL_THRESHOLD)).cast("int"))
              .select("id", "h", *FEATURES, "label", *extra))


def feat_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ID_PARTS + FEATURES + ["l_returnflag"])
    return (li.withColumn("id", _id_expr())
              .withColumn("h", md5_key("id", seed=SEED))
              .select("id", "h", "l_quantity", "l_extendedprice",
                      F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
                      F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"),
                      "l_returnflag",
                      F.when(F.col("l_returnflag") == "R", F.lit(1))
                       .when(F.col("l_returnflag") == "A", F.lit(0)).alias("label")))


def dup_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem", ["l_quantity", "l_discount", "l_tax", "l_returnflag"])


def split_rows(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    """feat with split (20 % stratified test) and k stratified folds. The md5
    key is shuffled as its bytes, and a reader that needs few columns shuffles
    no others."""
    f = feat(spark, sf_dir).withColumn("h", F.unhex("h"))
    return split_and_folds(f, k=k).withColumn("h", F.lower(F.hex("h")))


def folded(spark: SparkSession, sf_dir: str, k: int = 5, columns=None) -> DataFrame:
    """``split_rows`` (of it ``columns``) held in memory, spilling to disk, as
    long as the query's result: for readers that read it several times (curves
    read it per branch); without it the md5 ranking would be recomputed per
    read. Lost blocks are recomputed from lineage."""
    rows = split_rows(spark, sf_dir, k)
    return held(rows.select(*columns) if columns else rows)


def scorecard_preds(df: DataFrame, keep=("id", "split", "label")) -> DataFrame:
    """Long predictions of the fixed scorecards over a split frame. One scan,
    four rows per input row (inline of a literal array of structs)."""
    price = F.col("l_extendedprice") / F.lit(105000.0)
    qty = F.col("l_quantity") / F.lit(50.0)
    blend = (price + qty) / F.lit(2.0)
    null = F.lit(None).cast("double")

    def card(name, score, pred):
        return F.struct(F.lit(name).alias("model"), score.alias("score"),
                        pred.cast("int").alias("prediction"))

    cards = F.array(card("price", price, price >= 0.5),
                    card("quantity", qty, qty >= 0.5),
                    card("blend", blend, blend >= 0.5),
                    card("hard", null, F.col("l_quantity") >= 25))
    keep = list(keep)
    return df.select(*keep, F.inline(cards)).select(
        "model", *keep, "score", "prediction")


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scorecard_preds(folded(spark, sf_dir))


def training_times() -> dict:
    return dict(SCORECARDS)


def model_order() -> dict:
    """Insertion order of the models (the reference keeps results in a list
    and breaks ties by that order)."""
    return {m: i for i, (m, _) in enumerate(SCORECARDS)}


def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-model metrics of the scorecards: one aggregate, so the split is read once and not held."""
    from tabml.operators import evaluate
    return evaluate.model_metrics(scorecard_preds(split_rows(spark, sf_dir)), training_times())


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-model metrics of the scorecards, with their insertion order. The
    reports read them several times: held, a row per model."""
    from tabml.operators.report import with_order
    return held(with_order(model_metrics(spark, sf_dir), model_order()))


def documents_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions that arrive separately from the labels: a length rule on
    ``documents`` joined to ``labels`` on the key (an equi-join; AQE picks a
    broadcast only when the runtime size of a side allows it)."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "lang", "n_chars"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    scored = docs.select("doc_id", "lang",
                         (F.col("n_chars") >= F.lit(DOC_LENGTH_RULE)).cast("int").alias("prediction"))
    return (scored.join(labels, on="doc_id", how="inner")
                  .select("doc_id", "lang", F.col("quality").alias("label"), "prediction"))


DOC_LENGTH_RULE = 2000


EMBED_DIMS = 64


def embedding_columns(spark: SparkSession, sf_dir: str, dims: int = EMBED_DIMS) -> DataFrame:
    """The ``dims`` embedding coordinates as double columns e0..e{dims-1}
    plus a binary label (class < 5): a wide numeric table."""
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    return e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(dims)],
                    (F.col("label") < 5).cast("int").alias("label"))
