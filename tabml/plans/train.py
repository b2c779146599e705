"""Training plans: randomised search with stratified folds, fit + evaluate,
the multi-model loop, learning curves, permutation / impurity importance,
batch scoring and model persistence.

Fits are of ``tabml.fits``: all candidates, folds and sizes of a learner advance
together over one persisted frame (the stratified folds of
``tabml.operators.split``). A spec without such a learner is searched by
``CrossValidator(foldCol='fold')``. Only small results come back to the driver:
metrics rows (one per model), chosen parameters, the models, and importance
vectors (one value per feature).
"""

from __future__ import annotations

import itertools
import json
import random
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.fits import learners as fl
from tabml.fits.frame import KEY, RANK, Frame, Part, training_frame
from tabml.functions.exprs import binary_bucket
from tabml.operators.evaluate import model_metrics
from tabml.operators.scale import apply_scaler, scale_split
from tabml.operators.split import fold_train_ranks, learning_curve_sizes, permuted_copies
from tabml.plans.ml_frame import assemble, feature_dim, to_preds
from tabml.plans.models import ModelSpec, Preset
from tabml.session import work_dir
from tabml.sources.cache import held

SEED = 42


def ml_data(folded: DataFrame, features: list[str], method: str = "standard") -> DataFrame:
    """Scaled (fit on train), assembled training frame: id, split, fold,
    label (double), features, plus the raw feature columns. A table without
    ids has their hash ``train_key`` instead."""
    rank = [(F.col("rn") - F.col("n_test_c")).alias(RANK)] if {"rn", "n_test_c"} <= set(folded.columns) else []
    own = [c for c in ("id", KEY, "h") if c in folded.columns]
    base = folded.select(*own, "split", "fold", "label", *rank, *features)
    scaled = scale_split(base, features, method)
    return assemble(scaled, features).withColumn("label", F.col("label").cast("double"))


def _combos(grid: dict) -> list[dict]:
    keys = sorted(grid)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])]


def sample_params(grid: dict, n_iter: int, seed: int = SEED) -> list[dict]:
    """Random draws without replacement from the grid; the whole grid when it
    has no more than n_iter points."""
    combos = _combos(grid)
    if len(combos) <= n_iter:
        return combos
    idx = random.Random(seed).sample(range(len(combos)), n_iter)
    return [combos[i] for i in idx]


@dataclass
class SearchResult:
    model: object
    best_params: dict | None
    n_candidates: int
    cv_scores: list


def random_search(spec: ModelSpec, train: DataFrame, n_iter: int, folds: int,
                  seed: int = SEED, parallelism: int = 4, frame: Frame | None = None) -> SearchResult:
    """Random draws of the grid by mean accuracy over the folds of ``train``; the best is fitted on all of it.
    ``frame`` is the frame of ``train`` with these folds, when several searches share it."""
    cands = sample_params(spec.effective_grid(), n_iter, seed)
    if spec.learner is not None:
        own = frame or training_frame(train, folds)
        try:
            model, best, scores = fl.search(spec.learner, own, cands)
        finally:
            if frame is None:
                own.release()
        return SearchResult(fl.FittedModel(model, own.dim), cands[best], len(cands), scores)
    d = feature_dim(train)
    est = spec.build(d)
    maps = [spec.param_map(est, c, d) for c in cands]
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps,
                        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"),
                        foldCol="fold", numFolds=folds, parallelism=min(parallelism, len(maps)),
                        seed=seed)
    cvm = cv.fit(train.where(F.col("fold").isNotNull()))
    scores = list(cvm.avgMetrics)
    best = max(range(len(scores)), key=lambda i: (scores[i], -i))
    return SearchResult(cvm.bestModel, cands[best], len(cands), scores)


def fit_default(spec: ModelSpec, train: DataFrame, combo: dict | None = None, frame: Frame | None = None):
    """One fit on all rows of ``train`` (or of its ``frame``) with the given or the grid's first parameters."""
    combo = combo if combo is not None else _combos(spec.effective_grid())[0]
    if spec.learner is not None:
        own = frame or training_frame(train)
        try:
            return fl.FittedModel(spec.learner.models(own, [(Part(), combo)])[0], own.dim)
        finally:
            if frame is None:
                own.release()
    d = feature_dim(train)
    est = spec.build(d)
    return est.fit(train, spec.param_map(est, combo, d))


def fit_all(spec: ModelSpec, train: DataFrame, combos: list[dict]) -> list:
    """A fit on all rows of ``train`` for each combination, together over one frame where the learner can."""
    if spec.learner is None:
        return [fit_default(spec, train, c) for c in combos]
    with training_frame(train) as frame:
        return [fl.FittedModel(m, frame.dim) for m in spec.learner.models(frame, [(Part(), c) for c in combos])]


def invariants(preds: DataFrame, split: str = "test") -> DataFrame:
    """(model, n_scored, n_invalid_scores, beats_majority): every row scored,
    scores inside [0, 1] (or NULL for margin-only models), predictions in
    {0, 1}, accuracy above the majority-class rate."""
    p = preds.where(F.col("split") == split)
    bad = ((F.col("score").isNotNull() & (F.isnan("score") | (F.col("score") < 0) | (F.col("score") > 1)))
           | ~F.col("prediction").isin(0, 1) | F.col("prediction").isNull())
    agg = p.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(bad).alias("n_invalid_scores"),
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("acc"),
        F.avg(F.col("label").cast("double")).alias("pos_rate"))
    return agg.select("model", "n_scored", "n_invalid_scores",
                      (F.col("acc") > F.greatest(F.col("pos_rate"), 1 - F.col("pos_rate")))
                      .alias("beats_majority"))


def evaluate_model(spec: ModelSpec, data: DataFrame, p: Preset, search: bool = True, frame: Frame | None = None) -> dict:
    """Search (or fit), score train and test, compute metrics; the wall time
    covers search + refit + scoring, like the reference. ``frame`` is the frame
    of the training rows, when several models share it."""
    t0 = time.time()
    train = data.where(F.col("split") == "train")
    cv_acc = None
    if search and spec.grid:
        res = random_search(spec, train, p.n_iter, p.folds, frame=frame)
        model, params, n_cand = res.model, res.best_params, res.n_candidates
        cv_acc = float(max(res.cv_scores)) if res.cv_scores else None
    else:
        model, params, n_cand = fit_default(spec, train, frame=frame), None, 1
    preds = to_preds(model.transform(data), spec.name)
    row = model_metrics(preds).first()
    elapsed = time.time() - t0
    best = {k: json.dumps(v) if not isinstance(v, str) else v for k, v in (params or {}).items()}
    lr = best.get(spec.lr_param) if spec.lr_param else None
    return dict(model=spec.name, train_accuracy=row["train_accuracy"], test_accuracy=row["test_accuracy"],
                training_time=elapsed, sensitivity=row["sensitivity"], specificity=row["specificity"],
                precision=row["precision"], best_params=best or {"params": "Default"},
                learning_rate=lr, cv_accuracy=cv_acc, n_candidates=n_cand, fitted=model, preds=preds)


METRICS_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("train_accuracy", T.DoubleType()),
    T.StructField("test_accuracy", T.DoubleType()), T.StructField("training_time", T.DoubleType()),
    T.StructField("sensitivity", T.DoubleType()), T.StructField("specificity", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("best_params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("learning_rate", T.StringType()),
    # best mean fold accuracy of the search (NULL without one): selection on
    # the folds, reported next to the single test split
    T.StructField("cv_accuracy", T.DoubleType())])
ERRORS_SCHEMA = T.StructType([T.StructField("model", T.StringType()),
                              T.StructField("message", T.StringType())])


def train_and_evaluate(spark: SparkSession, data: DataFrame, p: Preset, names=None,
                       search: bool = True, parallelism: int = 1):
    """The multi-model loop: a failing model is recorded in ``errors`` and
    skipped. Returns (metrics, preds, errors, fitted models by name). The
    metrics / errors tables have one row per model (built on the driver).
    ``data`` is persisted (every model reads it several times) and stays so
    because ``preds`` reads it lazily; a registered query releases it with its
    result, another caller by ``data.unpersist()``.

    ``parallelism`` > 1 runs that many models' searches at once on driver
    threads (better use of a large cluster); each model's ``training_time``
    then includes waiting for shared executors."""
    rows, errors, fitted, preds = [], [], {}, []
    data = held(data)
    specs = [s for s in p.specs if not names or s.name in names]
    folds = p.folds if "fold" in data.columns else 0
    frame = training_frame(data.where(F.col("split") == "train"), folds) if any(s.learner is not None for s in specs) else None

    def run(spec):
        try:
            return spec, evaluate_model(spec, data, p, search, frame), None
        except Exception as e:  # noqa: BLE001 -- recorded, as in the reference loop
            return spec, None, f"{type(e).__name__}: {e}"

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            results = list(pool.map(run, specs))        # keeps the models' order
    finally:
        if frame is not None:
            frame.release()
    for spec, r, err in results:
        if err is not None:
            errors.append((spec.name, err))
            continue
        fitted[spec.name] = r.pop("fitted")
        preds.append(r.pop("preds"))
        r.pop("n_candidates")
        rows.append(r)
    metrics = spark.createDataFrame([tuple(r[f.name] for f in METRICS_SCHEMA.fields) for r in rows],
                                    METRICS_SCHEMA)
    all_preds = preds[0] if preds else None
    for x in preds[1:]:
        all_preds = all_preds.unionByName(x)
    return metrics, all_preds, spark.createDataFrame(errors, ERRORS_SCHEMA), fitted


# ------------------------------------------------------------ learning curves

def curve_frame(data: DataFrame, k: int) -> Frame:
    """The frame that the learning curves of several learners share."""
    return training_frame(data.where(F.col("split") == "train"), k, curve=True)


def learning_curve(spec: ModelSpec, data: DataFrame, k: int, fractions=None,
                   combo: dict | None = None, parallelism: int = 4, frame: Frame | None = None) -> DataFrame:
    """(model, fold, train_size, train_score, val_score): one fit per (fold,
    size) on the leading rows (hash order) of the fold's training part. The
    fits advance together over ``frame`` (of ``curve_frame``; made here when not
    given); those of a spec without such a learner run on driver threads.
    ``data`` must carry folds 0..k-1."""
    spark = data.sparkSession
    train = data.where(F.col("split") == "train")
    counts = {r["fold"]: r["count"] for r in train.groupBy("fold").count().collect()}
    n_max = sum(counts.values()) - counts.get(0, 0)
    sizes = learning_curve_sizes(n_max, fractions)
    schema = "model string, fold int, train_size bigint, train_score double, val_score double"
    if spec.learner is not None:
        own = frame or curve_frame(data, k)
        try:
            params = combo if combo is not None else _combos(spec.effective_grid())[0]
            return spark.createDataFrame([(spec.name, *row) for row in fl.curve(spec.learner, own, sizes, params)], schema)
        finally:
            if frame is None:
                own.release()
    ranked = fold_train_ranks(train, k).persist(StorageLevel.MEMORY_AND_DISK)
    acc = MulticlassClassificationEvaluator(metricName="accuracy")

    def one(f_s):
        f, s = f_s
        sub = ranked.where((F.col("cv_fold") == f) & (F.col("rank_f") <= s))
        m = fit_default(spec, sub, combo)
        val = train.where(F.col("fold") == f)
        return (spec.name, f, s, acc.evaluate(m.transform(sub)), acc.evaluate(m.transform(val)))

    jobs = [(f, s) for f in range(k) for s in sizes]
    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            out = list(pool.map(one, jobs))
    finally:
        ranked.unpersist()
    return spark.createDataFrame(out, schema)


# ------------------------------------------------------------------ importance

def tree_importance(model, name: str, names: list[str], spark: SparkSession) -> DataFrame:
    """Impurity importance of a tree ensemble: (model, feature, importance)."""
    vec = model.featureImportances.toArray().tolist()
    return spark.createDataFrame([(name, f, float(v)) for f, v in zip(names, vec)],
                                 "model string, feature string, importance double")


def permutation_importance(model, name: str, test: DataFrame, features: list[str],
                           n_repeats: int = 10, seed: int = SEED) -> DataFrame:
    """``permutation_importances`` of one model."""
    return permutation_importances({name: model}, test, features, n_repeats, seed)


def permutation_importances(models: dict, test: DataFrame, features: list[str],
                            n_repeats: int = 10, seed: int = SEED) -> DataFrame:
    """(model, feature, importance, importance_std): baseline accuracy minus
    accuracy with one feature permuted, mean and deviation over repeats. Every
    test row meets its permuted values once a repeat; fitted learners judge the
    copies of all features in that task and return counts (``_judged``, run at once).
    Other models add their prediction to the copies themselves
    (``permuted_copies``), reduced by a grouped aggregate to the same rows, one
    per (feature, repeat)."""
    base = test.select("id", "label", *features)
    if all(isinstance(m, fl.FittedModel) for m in models.values()):
        per = _judged(base, list(models.values()), features, n_repeats, seed)
    else:
        copies = permuted_copies(base, features, n_repeats, seed=seed)
        plain = base.withColumn("repeat", F.lit(-1)).withColumn("feature", F.lit(None).cast("string"))
        scored = assemble(copies.unionByName(plain), features)
        for i, model in enumerate(models.values()):
            kept = scored.columns
            scored = model.transform(scored).select(*kept, F.col("prediction").alias(f"prediction_{i}"))
        per = scored.groupBy("feature", "repeat").agg(*[
            F.avg((F.col("label") == F.col(f"prediction_{i}")).cast("double")).alias(f"acc_{i}") for i in range(len(models))])
    rows = per.select("feature", F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"acc_{i}").alias("acc"))
                                                     for i, n in enumerate(models)])).alias("r")).select("feature", "r.*")
    # a model has features x repeats + 1 rows: the baseline is its NULL-feature row
    baseline = F.max(F.when(F.col("feature").isNull(), F.col("acc"))).over(Window.partitionBy("model"))
    drop = F.col("base") - F.col("acc")
    return (rows.withColumn("base", baseline).where(F.col("feature").isNotNull())
                .groupBy("model", "feature").agg(F.avg(drop).alias("importance"),
                                                 F.stddev_pop(drop).alias("importance_std")))


#: Rows of a stretch of ranks whose rows and permuted values meet in one task, at least.
MEET_ROWS = 1 << 14
#: Frees a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark: SparkSession):
    """Queries made inside leave no shuffle files behind, so one at a time need the disk of one."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def _judged(base: DataFrame, models: list, features: list[str], n_repeats: int, seed: int) -> DataFrame:
    """(feature, repeat, acc_0, acc_1, ...): each model's accuracy on the plain rows (feature NULL) and on every permuted copy.
    The permutations are those of ``permuted_pairs``, a repeat at a time: rows and values are shuffled once, to the
    stretch of ranks that they fall in, and ranked where they meet. Only counts come back."""
    spark = base.sparkSession
    shared = spark.sparkContext.broadcast([m.model for m in models])
    base = base.select("id", F.col("label").cast("double").alias("label"), *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    d, counts = len(features), [f"right_{i}" for i in range(len(models))]
    schema = "f int, n double, " + ", ".join(f"{c} double" for c in counts)

    def judged(label, x, moved):
        """``(f, n, right_0, right_1, ...)`` of some rows; without permuted values of the rows as they are (f = -1)."""
        if np.isnan(x).any() or moved is not None and np.isnan(moved).any():
            raise ValueError("features must not be NULL or NaN (impute them first)")
        for f in range(d) if moved is not None else (-1,):
            z = x
            if f >= 0:
                z = x.copy()
                z[:, f] = moved[:, f]
            yield f, float((~np.isnan(label)).sum()), *(float((m.decide(z)[1] == label).sum()) for m in shared.value)

    def numbers(batch, first, n=1):
        return np.column_stack([batch.column(first + i).to_numpy(zero_copy_only=False).astype(float) for i in range(n)])

    def records(rows):
        columns = list(zip(*rows)) or [()] * (2 + len(models))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.float64()) for c in columns[1:])], names=["f", "n", *counts])

    def plain(batches):
        for batch in batches:
            if batch.num_rows:
                yield records(judged(numbers(batch, 0)[:, 0], numbers(batch, 1, d), None))

    def sums(counted):
        return {r.f: r for r in counted.groupBy("f").agg(*[F.sum(c).alias(c) for c in ("n", *counts)]).collect()}

    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with _shuffles_freed(spark):
            found = [(-1, sums(base.drop("id").mapInArrow(plain, schema)))]
            for repeat in range(n_repeats):
                met = _met(base, d, repeat, seed)
                if met is not None:
                    found.append((repeat, sums(met(lambda label, x, moved: records(judged(label, x, moved)), schema))))
    finally:
        base.unpersist()
        shared.unpersist()
    out = [(features[f] if f >= 0 else None, repeat, *[r[c] / r.n if r.n else None for c in counts])
           for repeat, by_feature in found for f, r in by_feature.items()]
    return spark.createDataFrame(out, "feature string, repeat int, " + ", ".join(f"acc_{i} double" for i in range(len(models))))


def _met(base: DataFrame, d: int, repeat: int, seed: int):
    """``met(give, schema)``: a frame of the record batches ``give(labels, features, permuted values)`` of the stretches of
    ranks of one repeat; None without rows. ``base`` has id, label and x0, x1, ..; ranks are of the two md5 orders of
    ``permuted_pairs``, and a row goes to each stretch that its bucket (two leading bytes) reaches into."""
    spark = base.sparkSession

    def side(tag, number):
        key = F.unhex(F.md5(F.concat(F.lit(f"{seed}:{tag}{repeat}|"), F.col("id").cast("string"))))
        label = F.col("label") if number == 0 else F.lit(None).cast("double").alias("label")
        keyed = base.select(key.alias("key"), label, *[f"x{i}" for i in range(d)]).where("key is not null")
        return keyed.withColumn("b", binary_bucket("key", 4)).withColumn("side", F.lit(number))

    sides = [side("a", 0), side("b", 1)]
    both = sides[0].select("side", "b").unionByName(sides[1].select("side", "b")).groupBy("side", "b").count().toArrow()
    of, bucket, size = (np.asarray(both.column(c)) for c in ("side", "b", "count"))
    total = int(size[of == 0].sum())
    if not total:
        return None
    held = np.zeros((2, 1 << 16), np.int64)
    held[of, bucket] = size
    starts = np.concatenate([np.zeros((2, 1), np.int64), held.cumsum(axis=1)[:, :-1]], axis=1)
    long = max(MEET_ROWS, 32 * total >> 16)   # of many buckets, so that few rows reach into two
    first, last = starts // long, (starts + np.maximum(held, 1) - 1) // long
    of, bucket = np.nonzero(held)
    # a row for each side and bucket: the broadcast is bounded by 2 x 65,536
    reach = spark.createDataFrame(pa.table({"side": pa.array(of, pa.int32()), "b": pa.array(bucket, pa.int64()),
                                            "first": pa.array(first[of, bucket]), "last": pa.array(last[of, bucket])}))
    rows = sides[0].unionByName(sides[1]).withColumn("b", F.col("b").cast("bigint")).join(F.broadcast(reach), on=["side", "b"])
    stretches = -(-total // long)
    parts = min(stretches, max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = rows.select(F.explode(F.sequence("first", "last")).alias("stretch"), "side", "key", "label", *[f"x{i}" for i in range(d)])
    rows = rows.repartitionById(parts, F.pmod("stretch", F.lit(parts)).cast("int"))   # as many stretches in each
    rows = rows.sortWithinPartitions("stretch", "side", "key")
    begin = spark.sparkContext.broadcast(starts)

    def met(give, schema):
        def pair(stretch, held):
            own = []
            for number, batches in enumerate(held):
                key = batches[0].column("key")[0].as_py()
                at = int(begin.value[number, key[0] * 256 + key[1]])
                table = pa.Table.from_batches(batches)
                x = np.column_stack([table.column(f"x{i}").to_numpy().astype(float) for i in range(d)])
                own.append((slice(stretch * long - at, min((stretch + 1) * long, total) - at), table, x))
            (cut, table, x), (cut_b, _, moved) = own
            label = table.column("label").to_numpy().astype(float)
            return give(label[cut], x[cut], moved[cut_b])

        def work(batches):
            now, held = None, ([], [])
            for batch in batches:
                if not batch.num_rows:
                    continue
                at = batch.column("stretch").to_numpy() * 2 + batch.column("side").to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), batch.num_rows]
                for a, z in zip(cuts, cuts[1:]):
                    stretch, number = divmod(int(at[a]), 2)
                    if stretch != now and now is not None:
                        yield pair(now, held)
                        held = ([], [])
                    now = stretch
                    held[number].append(batch.slice(a, z - a))
            if now is not None:
                yield pair(now, held)

        return rows.mapInArrow(work, schema)

    return met


# ------------------------------------------------------------- persistence

REGISTRY = "model string, slug string, path string, saved_at double"


def save_model(model, spark: SparkSession, name: str, folder: str | None = None) -> str:
    """Persist a fitted model under the shared folder, folder name = lower-cased
    name with blanks as underscores, and record (model, slug, path) in the
    registry, so the display name is read back exactly instead of being rebuilt
    from the folder name.

    Every save writes a folder of its own, and its registry entry, a file of
    its own, only when the model is complete: that file is the pointer to the
    version. A reader never sees half a model, and savers of one name do not
    disturb each other; the latest entry counts."""
    folder = (folder or work_dir(spark, "models")).rstrip("/")
    slug_name = name.lower().replace(" ", "_")
    version = uuid.uuid4().hex
    path = f"{folder}/{version}/{slug_name}"
    model.write().overwrite().save(path)
    entry = spark.createDataFrame([(name, slug_name, path, time.time())], REGISTRY)
    entry.coalesce(1).write.parquet(f"{folder}/_registry/{version}")
    return path


def model_registry(spark: SparkSession, folder: str | None = None) -> DataFrame:
    """Latest registry entry per model name."""
    folder = (folder or work_dir(spark, "models")).rstrip("/")
    reg = spark.read.schema(REGISTRY).option("recursiveFileLookup", True).parquet(f"{folder}/_registry")
    return reg.groupBy("model").agg(F.max_by(F.struct("slug", "path"), F.struct("saved_at", "path")).alias("e")) \
        .select("model", "e.slug", "e.path")


def load_model(spark: SparkSession, name: str, folder: str | None = None):
    """The saved model of a name, whatever its class."""
    row = model_registry(spark, folder).where(F.col("model") == name).first()
    if row is None:
        raise KeyError(f"no saved model named {name!r}")
    return DefaultParamsReader.loadParamsInstance(row["path"], spark)


class ScalerModel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted scaler as a pipeline stage: scales its columns in place."""

    fitted = Param(Params._dummy(), "fitted", "JSON of [method, {column: numbers}]",
                   typeConverter=TypeConverters.toString)

    def __init__(self, fitted: tuple[str, dict] | None = None):
        super().__init__()
        if fitted is not None:
            self._set(fitted=json.dumps(fitted))

    def _transform(self, df: DataFrame) -> DataFrame:
        method, params = json.loads(self.getOrDefault(self.fitted))
        return apply_scaler(df, (method, params))


def scoring_unit(scaler: tuple[str, dict], features, model) -> PipelineModel:
    """Scaler, assembler and learner as one model that scores unscaled rows; it saves and loads as a whole."""
    return PipelineModel([ScalerModel(scaler), VectorAssembler(inputCols=list(features), outputCol="features"), model])


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def fit_pipeline(stages, train: DataFrame) -> PipelineModel:
    return Pipeline(stages=stages).fit(train)

