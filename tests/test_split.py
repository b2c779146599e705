from pyspark.sql import functions as F

from tabml.operators.split import (class_allocation, cv_fold_layout, learning_curve_sizes,
                                   learning_curve_subsets, permute_column, split_and_folds,
                                   stratified_split)
from tabml.sources import bindings as b


def test_split_is_disjoint_exhaustive_and_stratified(spark, sf_small):
    f = b.feat(spark, sf_small)
    s = stratified_split(f)
    n = f.count()
    assert s.count() == n and s.select("id").distinct().count() == n
    n_test = s.where("split = 'test'").count()
    assert n_test == -(-n // 5)
    per = {(r.label, r.split): r["count"] for r in s.groupBy("label", "split").count().collect()}
    for lab in (0, 1):
        tot = per[(lab, "test")] + per[(lab, "train")]
        assert abs(per[(lab, "test")] - tot * n_test / n) <= 1


def test_split_independent_of_partitioning(spark, sf_small):
    f = b.feat(spark, sf_small)
    a = {r.id: r.split for r in stratified_split(f).collect()}
    c = {r.id: r.split for r in stratified_split(f.repartition(5)).collect()}
    assert a == c


def test_largest_remainder_allocation(spark):
    df = spark.createDataFrame([(0,)] * 7 + [(1,)] * 3, "label int")
    alloc = {r.label: (r.n_train_c, r.n_test_c) for r in class_allocation(df, "label", 0.25).collect()}
    # n_test = ceil(2.5) = 3; train 7 -> 7*7/10 = 4.9, 3*7/10 = 2.1 -> 4 + 2 = 6, need 1 -> class 0
    assert alloc == {0: (5, 2), 1: (2, 1)}


def test_folds_partition_each_class(spark, sf_small):
    fo = split_and_folds(b.feat(spark, sf_small), k=5).where("split = 'train'")
    per = fo.groupBy("label", "fold").count().collect()
    for lab in (0, 1):
        counts = [r["count"] for r in per if r.label == lab]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_learning_curve_subsets_nest(spark, sf_small):
    fo = split_and_folds(b.feat(spark, sf_small), k=5)
    rows = learning_curve_subsets(fo, k=5).collect()
    for f in range(5):
        sub = sorted([r for r in rows if r.cv_fold == f], key=lambda r: r.size_idx)
        assert [r.n_rows for r in sub] == [r.train_size for r in sub]
        assert all(a.n_pos <= b_.n_pos for a, b_ in zip(sub, sub[1:]))
    assert learning_curve_sizes(10) == list(range(1, 11))


def test_permutation_keeps_multiset(spark, sf_small):
    f = b.feat(spark, sf_small).select("id", "l_quantity")
    p = permute_column(f, "l_quantity", repeat=3)
    assert sorted(r[0] for r in f.select("l_quantity").collect()) == \
        sorted(r[0] for r in p.select("l_quantity").collect())
    assert p.count() == f.count()
    moved = p.join(f.withColumnRenamed("l_quantity", "orig"), "id").where("orig <> l_quantity").count()
    assert moved > 0


def test_cv_layout_shape(spark, sf_small):
    lay = cv_fold_layout(b.feat(spark, sf_small), n_samples=100, k=5)
    assert lay.count() == 500
    tests = lay.where("role = 'test'").groupBy("sample_idx").count()
    assert tests.where("count <> 1").count() == 0
    assert lay.agg(F.max("sample_idx")).first()[0] == 99


def test_rows_without_label_stay_without_split(spark):
    from tabml.functions.exprs import md5_key
    from tabml.operators import split as sp

    df = spark.range(30).selectExpr("cast(id as string) as id", "case when id < 20 then cast(id % 2 as int) end as label")
    out = sp.split_and_folds(df.withColumn("h", md5_key("id", seed=1)), k=3).collect()
    assert len(out) == 30
    assert all((r.split is None) == (r.label is None) for r in out)
    assert all(r.fold is None for r in out if r.label is None)
