"""Deterministic stratified hold-out split, stratified k folds, the CV layout
table, nested learning-curve subsets and seeded column permutation.

Rows are ordered by an md5 key of their id (seeded), never by physical
order or ``rand()``: results do not depend on partitioning, on retries after a
lost executor, or on the engine.

Per-class sizes follow the rules of the usual stratified samplers:

* hold-out: ``n_test = ceil(n * test_size)``; the training share of each class
  is the largest-remainder allocation of ``n - n_test`` (ties: lower class
  first); the test rows of a class are its lowest-hash rows;
* k folds (on the training rows): classes are laid out in label order and
  positions are dealt round-robin, so fold ``(offset_c + rank - 1) % k``.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabml.functions.exprs import hex_bucket, md5_key
from tabml.functions.rank import bucketed_cumsum, hash_rank

DEC = "decimal(38,0)"


def _idiv(a: Column, b: Column) -> Column:
    """Exact integer division of non-negative integers (decimal(38,0) safe)."""
    a, b = a.cast(DEC), b.cast(DEC)
    return ((a - F.pmod(a, b)) / b).cast(DEC)


def class_allocation(df: DataFrame, label_col: str = "label", test_size: float = 0.2) -> DataFrame:
    """(label, n_c, n_train_c, n_test_c, train_offset) -- one row per class."""
    cls = (df.where(F.col(label_col).isNotNull())
             .groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n_c")))
    return allocation_from_counts(cls, test_size)


def allocation_from_counts(cls: DataFrame, test_size: float = 0.2) -> DataFrame:
    """Allocation from a (label, n_c) class-count table."""
    frac = Fraction(test_size).limit_denominator(1_000_000)
    num, den = frac.numerator, frac.denominator
    # The class table has one row per label value: the unpartitioned windows
    # below run over a handful of rows.
    all_ = Window.partitionBy()
    n = F.sum("n_c").over(all_).cast(DEC)
    n_test = _idiv(n * F.lit(num) + F.lit(den - 1), F.lit(den))
    alloc = (cls.withColumn("n", n)
                .withColumn("n_train", F.col("n") - n_test)
                .withColumn("tr_fl", _idiv(F.col("n_c") * F.col("n_train"), F.col("n")))
                .withColumn("tr_rem", F.pmod(F.col("n_c").cast(DEC) * F.col("n_train"), F.col("n")))
                .withColumn("need", F.col("n_train") - F.sum("tr_fl").over(all_))
                .withColumn("rk", F.row_number().over(
                    Window.orderBy(F.col("tr_rem").desc(), F.col("label").asc())))
                .withColumn("n_train_c", (F.col("tr_fl") + F.when(F.col("rk") <= F.col("need"), 1)
                                          .otherwise(0)).cast("bigint"))
                .withColumn("n_test_c", F.col("n_c") - F.col("n_train_c"))
                .withColumn("train_offset", F.coalesce(F.sum("n_train_c").over(
                    Window.orderBy("label").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                    .cast("bigint")))
    return alloc.select("label", "n_c", "n_train_c", "n_test_c", "train_offset")


def stratified_split(df: DataFrame, label_col: str = "label", key_col: str = "h",
                     test_size: float = 0.2, split_col: str = "split") -> DataFrame:
    """Adds ``split`` ('train' / 'test') and ``rn`` (rank of the row's hash
    inside its class). Rows with a NULL label stay, with a NULL split and rank."""
    ranked, totals = hash_rank(df.where(F.col(label_col).isNotNull()), [label_col], key_col,
                               out="rn", return_totals=True)
    # class sizes from the rank's bucket totals: no second pass over the rows
    cls = totals.groupBy(F.col(label_col).alias("label")).agg(
        F.sum("rn_total").cast("bigint").alias("n_c"))
    alloc = allocation_from_counts(cls, test_size)
    a = alloc.select(F.col("label").alias(label_col), "n_test_c", "train_offset")
    # alloc has one row per class: broadcast is bounded by the label domain.
    out = ranked.join(F.broadcast(a), on=label_col)
    out = out.withColumn(split_col, F.when(F.col("rn") <= F.col("n_test_c"), F.lit("test"))
                         .otherwise(F.lit("train")))
    return out.unionByName(df.where(F.col(label_col).isNull()), allowMissingColumns=True)


def stratified_kfold(split_df: DataFrame, k: int = 5, label_col: str = "label",
                     split_col: str = "split", fold_col: str = "fold") -> DataFrame:
    """Fold id for the training rows of ``stratified_split`` output (test rows
    get NULL). Uses the rank already computed by the split: no extra shuffle."""
    train_rank = F.col("rn") - F.col("n_test_c")
    fold = F.pmod(F.col("train_offset") + train_rank - 1, F.lit(k)).cast("int")
    return split_df.withColumn(fold_col, F.when(F.col(split_col) == "train", fold))


def split_and_folds(df: DataFrame, k: int = 5, test_size: float = 0.2,
                    label_col: str = "label", key_col: str = "h") -> DataFrame:
    return stratified_kfold(stratified_split(df, label_col, key_col, test_size), k, label_col)


def split_balance(split_df: DataFrame, label_col: str = "label") -> DataFrame:
    """(split, label, n, share) -- class balance of each part."""
    per = split_df.groupBy("split", label_col).agg(F.count(F.lit(1)).alias("n"))
    tot = split_df.groupBy("split").agg(F.count(F.lit(1)).alias("n_split"))
    return (per.join(F.broadcast(tot), on="split")
               .withColumn("share", F.round(F.col("n") / F.col("n_split"), 6))
               .select("split", label_col, "n", "n_split", "share"))


def cv_fold_layout(df: DataFrame, n_samples: int = 100, k: int = 5,
                   label_col: str = "label", key_col: str = "h", id_col: str = "id") -> DataFrame:
    """Train/test role of the first ``n_samples`` rows (hash order) in each of
    ``k`` stratified folds computed on that sample: (fold, sample_idx, id,
    label, role). The sample size is the feature (a fixed-size layout view),
    taken with a bounded top-k, not a global sort."""
    sample = df.select(id_col, label_col, key_col).orderBy(key_col).limit(n_samples)
    # The sample has n_samples rows, so plain windows over it are bounded.
    w_pos = Window.orderBy(key_col)
    w_cls = Window.partitionBy(label_col).orderBy(key_col)
    w_off = Window.orderBy(label_col)
    cls = sample.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_c"))
    cls = cls.withColumn("offset", F.coalesce(F.sum("n_c").over(
        w_off.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    s = (sample.withColumn("sample_idx", F.row_number().over(w_pos) - 1)
               .withColumn("rank_c", F.row_number().over(w_cls))
               .join(cls.select(label_col, "offset"), on=label_col)
               .withColumn("own_fold", F.pmod(F.col("offset") + F.col("rank_c") - 1, F.lit(k)).cast("int")))
    lay = s.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    return lay.select("fold", "sample_idx", id_col, label_col,
                      F.when(F.col("fold") == F.col("own_fold"), F.lit("test"))
                       .otherwise(F.lit("train")).alias("role"))


def learning_curve_sizes(n_max: int, fractions=None) -> list[int]:
    """Absolute subset sizes: floor(fraction * n_max) clipped to [1, n_max],
    unique, for fractions 0.1, 0.2, ..., 1.0 by default (exact integers)."""
    if fractions is None:
        sizes = [(i * n_max) // 10 for i in range(1, 11)]
    else:
        sizes = [int(Fraction(f).limit_denominator(1_000_000) * n_max) for f in fractions]
    return sorted({min(max(s, 1), n_max) for s in sizes})


def fold_train_ranks(folded: DataFrame, k: int, key_col: str = "h",
                     digits: int = 4) -> DataFrame:
    """For each fold f, rank (1-based, hash order) of every training row that
    is *not* in fold f: rows (cv_fold, rank_f, ...), k-1 per training row.

    One bucketed prefix sum over the training rows carries k + 1 running
    counts (all rows, and rows of each fold); for a row outside fold f,
    rank_f = rank - (rows of fold f before it). The k-1 copies per row are
    made after the ranking, as a projection, so no copy is shuffled;
    ``fold_rank_array`` has the ranks without copies."""
    ranked = fold_rank_array(folded.where(F.col("split") == "train"), k, key_col, "__ranks", digits)
    per_fold = F.array(*[F.struct(F.lit(f).alias("cv_fold"), F.col("__ranks")[f].alias("rank_f")) for f in range(k)])
    return ranked.select("*", F.inline(per_fold)).where(F.col("cv_fold") != F.col("fold")).drop("__ranks")


def fold_rank_array(train: DataFrame, k: int, key_col: str = "h", out: str = "ranks", digits: int = 4) -> DataFrame:
    """Adds the array of each training row's ranks (hash order) in the training parts of folds 0..k-1;
    the entry of the row's own fold is the number of such rows before it."""
    counts = {"__all": F.lit(1).cast("bigint")}
    counts.update({f"__c{f}": (F.col("fold") == f).cast("bigint") for f in range(k)})
    ranked = bucketed_cumsum(train, [], key_col, hex_bucket(key_col, digits), counts)
    ranks = F.array(*[F.col("__all") - F.col(f"__c{f}") for f in range(k)])
    return ranked.withColumn(out, ranks).drop("__all", *[f"__c{f}" for f in range(k)])


def learning_curve_subsets(folded: DataFrame, k: int = 5, fractions=None,
                           label_col: str = "label") -> DataFrame:
    """(cv_fold, size_idx, train_size, n_rows, n_pos): the nested training
    subsets of each fold (leading rows in hash order). Sizes come from the
    training part of fold 0, like the usual learning-curve helper."""
    counts = (folded.where(F.col("split") == "train").groupBy("fold").count().collect())
    n_train = sum(r["count"] for r in counts)  # bounded: k rows
    n_fold0 = next((r["count"] for r in counts if r["fold"] == 0), 0)
    sizes = learning_curve_sizes(n_train - n_fold0, fractions)
    ranks = fold_train_ranks(folded, k)
    size_arr = F.array(*[F.lit(s).cast("bigint") for s in sizes])
    # index of the smallest subset that contains the row
    mask = F.transform(size_arr, lambda s: s >= F.col("rank_f"))
    idx0 = (F.array_position(mask, F.lit(True)) - 1).cast("int")
    per = (ranks.where(F.col("rank_f") <= F.lit(sizes[-1]))
                .withColumn("first_idx", idx0)
                .groupBy("cv_fold", "first_idx")
                .agg(F.count(F.lit(1)).alias("n"),
                     F.sum(F.col(label_col).cast("bigint")).alias("pos")))
    grid = (per.select("cv_fold").distinct()
               .withColumn("size_idx", F.explode(F.sequence(F.lit(0), F.lit(len(sizes) - 1)))))
    joined = grid.join(per, on="cv_fold").where(F.col("first_idx") <= F.col("size_idx"))
    out = (joined.groupBy("cv_fold", "size_idx")
                 .agg(F.sum("n").alias("n_rows"), F.sum("pos").alias("n_pos")))
    return out.withColumn("train_size", F.element_at(size_arr, F.col("size_idx") + 1)) \
              .select("cv_fold", "size_idx", "train_size", "n_rows", "n_pos")


def permute_column(df: DataFrame, column: str, id_col: str = "id", seed: int = 42,
                   repeat: int = 0, digits: int = 4) -> DataFrame:
    """Seeded permutation of one column: the value at rank r of hash order B
    moves to the row at rank r of hash order A (both orders depend on the
    repeat only). Exact, distributed (two bucketed ranks and one equi-join on
    the rank); keeps the multiset."""
    ha = md5_key(F.lit(f"a{repeat}"), id_col, seed=seed)
    hb = md5_key(F.lit(f"b{repeat}"), id_col, seed=seed)
    rows = hash_rank(df.withColumn("__ha", ha), [], "__ha", out="__r", digits=digits)
    vals = hash_rank(df.select(F.col(column).alias("__pv"), hb.alias("__hb")), [], "__hb",
                     out="__r", digits=digits).select("__r", "__pv")
    return (rows.join(vals, on="__r")
                .withColumn(column, F.col("__pv"))
                .drop("__ha", "__r", "__pv"))


def permuted_copies(df: DataFrame, features, n_repeats: int, id_col: str = "id",
                    seed: int = 42, digits: int = 4) -> DataFrame:
    """All (feature, repeat) permuted copies of ``df`` in one plan: in copy
    (f, r) column f holds its values permuted exactly as
    ``permute_column(df, f, repeat=r)`` does; the other columns are unchanged.
    Per repeat, rows are ranked by order A and all feature values together
    by order B (two bucketed ranks over R x n rows), joined one-to-one on
    (repeat, rank), and only then expanded to one copy per feature."""
    features = list(features)
    joined = permuted_pairs(df, features, n_repeats, id_col, seed, digits).drop("__r")
    out = joined.withColumn("feature", F.explode(F.array(*[F.lit(f) for f in features])))
    out = out.withColumns({f: F.when(F.col("feature") == f, F.col(f"__pv{i}")).otherwise(F.col(f))
                           for i, f in enumerate(features)})
    return out.drop(*[f"__pv{i}" for i in range(len(features))])


def permuted_pairs(df: DataFrame, features, n_repeats: int, id_col: str = "id",
                   seed: int = 42, digits: int = 4) -> DataFrame:
    """The rows of ``permuted_copies`` before their expansion: each row and repeat once, with
    the permuted values of all features as ``__pv0``, ``__pv1``, ... The md5 keys are shuffled as bytes."""
    reps = F.explode(F.sequence(F.lit(0), F.lit(n_repeats - 1))).alias("repeat")

    def key(tag):
        return F.unhex(F.md5(F.concat(F.lit(f"{seed}:{tag}"), F.col("repeat").cast("string"),
                                      F.lit("|"), F.col(id_col).cast("string"))))

    rows = df.select("*", reps).withColumn("__ha", key("a"))
    rows = hash_rank(rows, ["repeat"], "__ha", out="__r", digits=digits).drop("__ha")
    vals = df.select(id_col, *[F.col(f).alias(f"__pv{i}") for i, f in enumerate(features)], reps) \
             .withColumn("__hb", key("b"))
    vals = hash_rank(vals, ["repeat"], "__hb", out="__r", digits=digits) \
        .select("repeat", "__r", *[f"__pv{i}" for i in range(len(features))])
    return rows.join(vals, on=["repeat", "__r"])
