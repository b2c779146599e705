"""Independent SQL definitions (DuckDB dialect) of the registered queries.

They restate each operator with plain SQL windows and aggregates over the
driver tables, so a Spark result can be checked against a second engine.
Shared views (feat, split, folds, preds, metrics) are CTE text below.
"""

from __future__ import annotations

import re

# ------------------------------------------------------------------ bindings

FEAT = """
feat AS (
  SELECT id, md5('42:' || id) AS h, l_quantity, l_extendedprice, l_discount, l_tax,
         CAST(l_quantity * l_extendedprice * (1 - l_discount) > 1000000 AS INTEGER) AS label,
         l_returnflag
  FROM (SELECT *, concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                            CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                            CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR)) AS id
        FROM lineitem) t
)"""

FEAT_RAW = """
feat_raw AS (
  SELECT id, md5('42:' || id) AS h, l_quantity, l_extendedprice,
         nullif(l_discount, 0.0) AS l_discount, nullif(l_tax, 0.0) AS l_tax, l_returnflag,
         CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag = 'A' THEN 0 END AS label
  FROM (SELECT *, concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                            CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                            CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR)) AS id
        FROM lineitem) t
)"""


def split_ctes(src: str = "feat", name: str = "folded", k: int = 5,
               test_num: int = 1, test_den: int = 5) -> str:
    """Stratified split (ceil(n * num/den) test rows, largest-remainder train
    share per class, lowest-hash rows to test) and k round-robin folds."""
    return f"""
{name}_cls AS (SELECT label, count(*) AS n_c FROM {src} WHERE label IS NOT NULL GROUP BY label),
{name}_a0 AS (SELECT label, n_c, sum(n_c) OVER () AS n FROM {name}_cls),
{name}_a1 AS (SELECT *, n - (n * {test_num} + {test_den - 1}) // {test_den} AS n_train FROM {name}_a0),
{name}_a2 AS (SELECT *, (n_c * n_train) // n AS tr_fl, (n_c * n_train) % n AS tr_rem FROM {name}_a1),
{name}_a3 AS (SELECT *, n_train - sum(tr_fl) OVER () AS need,
                     row_number() OVER (ORDER BY tr_rem DESC, label) AS rk FROM {name}_a2),
{name}_a4 AS (SELECT label, n_c, CAST(tr_fl + CASE WHEN rk <= need THEN 1 ELSE 0 END AS BIGINT) AS n_train_c
              FROM {name}_a3),
{name}_alloc AS (SELECT label, n_c, n_train_c, n_c - n_train_c AS n_test_c,
                     coalesce(sum(n_train_c) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING
                                                   AND 1 PRECEDING), 0) AS train_offset
              FROM {name}_a4),
{name}_rk AS (SELECT s.*, row_number() OVER (PARTITION BY s.label ORDER BY s.h) AS rn
              FROM {src} s WHERE s.label IS NOT NULL),
{name} AS (SELECT r.*, CASE WHEN r.rn <= a.n_test_c THEN 'test' ELSE 'train' END AS split,
                  CASE WHEN r.rn > a.n_test_c
                       THEN CAST((a.train_offset + r.rn - a.n_test_c - 1) % {k} AS INTEGER) END AS fold
           FROM {name}_rk r JOIN {name}_alloc a USING (label))"""


PREDS = """
preds AS (
  SELECT 'price' AS model, id, split, label, l_extendedprice / 105000.0 AS score,
         CAST(l_extendedprice / 105000.0 >= 0.5 AS INTEGER) AS prediction FROM folded
  UNION ALL
  SELECT 'quantity', id, split, label, l_quantity / 50.0,
         CAST(l_quantity / 50.0 >= 0.5 AS INTEGER) FROM folded
  UNION ALL
  SELECT 'blend', id, split, label, (l_extendedprice / 105000.0 + l_quantity / 50.0) / 2.0,
         CAST((l_extendedprice / 105000.0 + l_quantity / 50.0) / 2.0 >= 0.5 AS INTEGER) FROM folded
  UNION ALL
  SELECT 'hard', id, split, label, CAST(NULL AS DOUBLE),
         CAST(l_quantity >= 25 AS INTEGER) FROM folded
)"""

TIMES = """
times AS (SELECT * FROM (VALUES ('price', 0.8::DOUBLE, 0), ('quantity', 0.3::DOUBLE, 1),
                                ('blend', 1.1::DOUBLE, 2), ('hard', 0.05::DOUBLE, 3))
          AS t(model, training_time, model_order))"""

METRICS = """
mcounts AS (
  SELECT model,
         count(*) FILTER (WHERE split = 'train') AS n_train,
         count(*) FILTER (WHERE split = 'train' AND label = prediction) AS train_correct,
         count(*) FILTER (WHERE split = 'test') AS n_test,
         count(*) FILTER (WHERE split = 'test' AND label = 1 AND prediction = 1) AS tp,
         count(*) FILTER (WHERE split = 'test' AND label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (WHERE split = 'test' AND label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (WHERE split = 'test' AND label = 1 AND prediction = 0) AS fn
  FROM preds GROUP BY model),
metrics AS (
  SELECT m.model, n_train, n_test,
         round(train_correct / n_train, 6) AS train_accuracy,
         round((tp + tn) / n_test, 6) AS test_accuracy,
         round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 6) AS sensitivity,
         round(CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END, 6) AS specificity,
         round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 6) AS precision,
         t.training_time, t.model_order
  FROM mcounts m JOIN times t USING (model))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


PRED_BASE = with_(FEAT, split_ctes(), PREDS)
METRIC_BASE = with_(FEAT, split_ctes(), PREDS, TIMES, METRICS)

SQL: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    # "column" is a keyword in DuckDB: quote it wherever it is an identifier
    SQL[name] = re.sub(r"(?<!['\"\w])column(?!['\"\w])", '"column"', sql)


# ------------------------------------------------------------ evaluation

register("model_metrics", METRIC_BASE + """
SELECT model, n_train, n_test, train_accuracy, test_accuracy, sensitivity, specificity,
       precision, training_time FROM metrics""")

register("confusion_matrix", PRED_BASE + """,
grid AS (SELECT DISTINCT model FROM preds WHERE split = 'test'),
cells AS (SELECT model, label, prediction, count(*) AS n FROM preds WHERE split = 'test'
          GROUP BY ALL)
SELECT g.model, l.label, p.prediction, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM grid g CROSS JOIN (VALUES (0), (1)) l(label) CROSS JOIN (VALUES (0), (1)) p(prediction)
LEFT JOIN cells c ON c.model = g.model AND c.label = l.label AND c.prediction = p.prediction""")

register("confusion_normalized", PRED_BASE + """,
grid AS (SELECT DISTINCT model FROM preds WHERE split = 'test'),
cells AS (SELECT model, label, prediction, count(*) AS n FROM preds WHERE split = 'test'
          GROUP BY ALL),
cm AS (SELECT g.model, l.label, p.prediction, CAST(coalesce(c.n, 0) AS BIGINT) AS n
       FROM grid g CROSS JOIN (VALUES (0), (1)) l(label) CROSS JOIN (VALUES (0), (1)) p(prediction)
       LEFT JOIN cells c ON c.model = g.model AND c.label = l.label AND c.prediction = p.prediction)
SELECT model, label, prediction, n,
       round(CASE WHEN sum(n) OVER (PARTITION BY model, label) > 0
                  THEN n / sum(n) OVER (PARTITION BY model, label) END, 6) AS rate
FROM cm""")

CONF = """,
cc AS (SELECT model, count(*) AS n,
              count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
              count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
              count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
              count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn
       FROM preds WHERE split = 'test' GROUP BY model)"""

register("classification_report", PRED_BASE + CONF + """,
pr AS (SELECT model, n,
              CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS p0,
              CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS r0,
              CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p1,
              CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r1,
              tn + fp AS s0, tp + fn AS s1, (tp + tn) / n AS acc FROM cc),
f AS (SELECT *, CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0,
                CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1 FROM pr),
rows AS (
  SELECT model, 'Benign' AS class, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM f
  UNION ALL SELECT model, 'Malignant', p1, r1, f1, s1 FROM f
  UNION ALL SELECT model, 'accuracy', NULL, NULL, acc, n FROM f
  UNION ALL SELECT model, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM f
  UNION ALL SELECT model, 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n,
                   (f0 * s0 + f1 * s1) / n, n FROM f)
SELECT model, class, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM rows""")

register("error_analysis", PRED_BASE + CONF + """
SELECT model, fp AS false_positives, fn AS false_negatives, fp + fn AS total_errors,
       round(CASE WHEN tn + fp > 0 THEN fp / (tn + fp) ELSE 0.0 END, 6) AS fp_rate,
       round(CASE WHEN fn + tp > 0 THEN fn / (fn + tp) ELSE 0.0 END, 6) AS fn_rate
FROM cc""")

ROC = """,
pts AS (SELECT model, score, sum(label) AS pos, sum(1 - label) AS neg
        FROM preds WHERE split = 'test' AND score IS NOT NULL GROUP BY model, score),
cum AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
               sum(pos) OVER (PARTITION BY model) AS P, sum(neg) OVER (PARTITION BY model) AS N
        FROM pts WINDOW w AS (PARTITION BY model ORDER BY score DESC
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

ROC_SELECT = """SELECT model, score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       round(CASE WHEN P > 0 THEN tp / P END, 6) AS tpr,
       round(CASE WHEN N > 0 THEN fp / N END, 6) AS fpr"""

ORIGIN = """SELECT DISTINCT model, CAST(NULL AS DOUBLE) AS threshold, CAST(0 AS BIGINT) AS tp,
       CAST(0 AS BIGINT) AS fp, 0.0::DOUBLE AS tpr, 0.0::DOUBLE AS fpr FROM cum"""

register("roc_curve", PRED_BASE + ROC + "\n" + ROC_SELECT + " FROM cum\nUNION ALL\n" + ORIGIN)

register("roc_curve_pruned", PRED_BASE + ROC + """,
nx AS (SELECT *, lead(pos) OVER w2 AS npos, lead(neg) OVER w2 AS nneg,
              row_number() OVER w2 AS i
       FROM cum WINDOW w2 AS (PARTITION BY model ORDER BY score DESC)),
kept AS (SELECT * FROM nx WHERE i = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg)
""" + ROC_SELECT + " FROM kept\nUNION ALL\n" + ORIGIN)

register("roc_auc", PRED_BASE + ROC + """
SELECT model, CAST(any_value(P) AS BIGINT) AS n_pos, CAST(any_value(N) AS BIGINT) AS n_neg,
       round(CAST(sum(neg * (2 * tp - pos)) AS DOUBLE)
             / (CAST(any_value(P) AS DOUBLE) * CAST(any_value(N) AS DOUBLE) * 2.0), 6) AS auc
FROM cum GROUP BY model""")

register("pr_curve", PRED_BASE + ROC + """
SELECT model, score AS threshold,
       round(tp / (tp + fp), 6) AS precision,
       round(CASE WHEN P = 0 THEN 1.0 ELSE tp / P END, 6) AS recall FROM cum
UNION ALL
SELECT DISTINCT model, CAST(NULL AS DOUBLE), 1.0::DOUBLE, 0.0::DOUBLE FROM cum""")

# ------------------------------------------------------------ split / folds

SPLIT_BASE = with_(FEAT, split_ctes())

register("stratified_split", SPLIT_BASE + """
SELECT id, label, split FROM folded""")

register("stratified_kfold", SPLIT_BASE + """
SELECT id, label, fold FROM folded WHERE split = 'train'""")

register("split_balance", SPLIT_BASE + """,
per AS (SELECT split, label, count(*) AS n FROM folded GROUP BY ALL),
tot AS (SELECT split, count(*) AS n_split FROM folded GROUP BY ALL)
SELECT split, label, n, n_split, round(n / n_split, 6) AS share FROM per JOIN tot USING (split)""")

FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

register("union_splits", SPLIT_BASE + """
SELECT id, split, label FROM folded WHERE split = 'train'
UNION ALL
SELECT id, split, label FROM folded WHERE split = 'test'""")

register("cv_fold_layout", with_(FEAT) + """,
sample AS (SELECT id, label, h FROM feat ORDER BY h LIMIT 100),
cls AS (SELECT label, count(*) AS n_c FROM sample GROUP BY label),
off AS (SELECT label, coalesce(sum(n_c) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING
                                                  AND 1 PRECEDING), 0) AS off FROM cls),
s AS (SELECT sample.*, row_number() OVER (ORDER BY h) - 1 AS sample_idx,
             row_number() OVER (PARTITION BY label ORDER BY h) AS rank_c FROM sample),
s2 AS (SELECT s.*, CAST((off + rank_c - 1) % 5 AS INTEGER) AS own_fold FROM s JOIN off USING (label))
SELECT f.fold, CAST(sample_idx AS INTEGER) AS sample_idx, id, label,
       CASE WHEN f.fold = own_fold THEN 'test' ELSE 'train' END AS role
FROM s2 CROSS JOIN (SELECT CAST(range AS INTEGER) AS fold FROM range(5)) f""")

SIZES = """,
tr AS (SELECT * FROM folded WHERE split = 'train'),
nmax AS (SELECT count(*) FILTER (WHERE fold <> 0) AS n FROM tr),
sizes AS (SELECT DISTINCT greatest(1, least(n, (i * n) // 10)) AS train_size
          FROM nmax, (SELECT range AS i FROM range(1, 11)) t),
sz AS (SELECT CAST(train_size AS BIGINT) AS train_size,
              CAST(row_number() OVER (ORDER BY train_size) - 1 AS INTEGER) AS size_idx FROM sizes),
ex AS (SELECT f.cv_fold, t.* FROM tr t,
              (SELECT CAST(range AS INTEGER) AS cv_fold FROM range(5)) f WHERE f.cv_fold <> t.fold),
rk AS (SELECT ex.*, row_number() OVER (PARTITION BY cv_fold ORDER BY h) AS rank_f FROM ex),
sub AS (SELECT rk.*, sz.train_size, sz.size_idx FROM rk JOIN sz ON rk.rank_f <= sz.train_size)"""

register("learning_curve_sizes", SPLIT_BASE + SIZES + """
SELECT cv_fold, size_idx, train_size, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_pos
FROM sub GROUP BY ALL""")

CURVE = SPLIT_BASE + SIZES + """,
sp AS (
  SELECT 'price' AS model, cv_fold, train_size, label,
         CAST(l_extendedprice / 105000.0 >= 0.5 AS INTEGER) AS prediction FROM sub
  UNION ALL SELECT 'quantity', cv_fold, train_size, label,
         CAST(l_quantity / 50.0 >= 0.5 AS INTEGER) FROM sub
  UNION ALL SELECT 'blend', cv_fold, train_size, label,
         CAST((l_extendedprice / 105000.0 + l_quantity / 50.0) / 2.0 >= 0.5 AS INTEGER) FROM sub
  UNION ALL SELECT 'hard', cv_fold, train_size, label, CAST(l_quantity >= 25 AS INTEGER) FROM sub),
vp AS (
  SELECT 'price' AS model, fold, label,
         CAST(l_extendedprice / 105000.0 >= 0.5 AS INTEGER) AS prediction FROM tr
  UNION ALL SELECT 'quantity', fold, label, CAST(l_quantity / 50.0 >= 0.5 AS INTEGER) FROM tr
  UNION ALL SELECT 'blend', fold, label,
         CAST((l_extendedprice / 105000.0 + l_quantity / 50.0) / 2.0 >= 0.5 AS INTEGER) FROM tr
  UNION ALL SELECT 'hard', fold, label, CAST(l_quantity >= 25 AS INTEGER) FROM tr),
trs AS (SELECT model, cv_fold, train_size,
               count(*) FILTER (WHERE label = prediction) / count(*) AS train_score
        FROM sp GROUP BY ALL),
vs AS (SELECT model, fold AS cv_fold,
              count(*) FILTER (WHERE label = prediction) / count(*) AS val_score
       FROM vp GROUP BY ALL),
scores AS (SELECT * FROM trs JOIN vs USING (model, cv_fold)),
curve AS (SELECT model, train_size, floor((list_reduce(list_sort(list(train_score)), lambda a, x: a + x) / count(*)) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE AS train_mean,
                 floor((sqrt(list_reduce(list_prepend(0.0::DOUBLE, list_transform(list_sort(list(train_score)), lambda x: (x - (list_reduce(list_sort(list(train_score)), lambda a, x: a + x) / count(*))) * (x - (list_reduce(list_sort(list(train_score)), lambda a, x: a + x) / count(*))))), lambda a, y: a + y) / count(*))) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE AS train_std,
                 floor((list_reduce(list_sort(list(val_score)), lambda a, x: a + x) / count(*)) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE AS val_mean, floor((sqrt(list_reduce(list_prepend(0.0::DOUBLE, list_transform(list_sort(list(val_score)), lambda x: (x - (list_reduce(list_sort(list(val_score)), lambda a, x: a + x) / count(*))) * (x - (list_reduce(list_sort(list(val_score)), lambda a, x: a + x) / count(*))))), lambda a, y: a + y) / count(*))) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE AS val_std,
                 count(*) AS n_folds
          FROM scores GROUP BY ALL)"""

register("learning_curve_agg", CURVE + """
SELECT * FROM curve""")

register("overfit_gap", CURVE + """,
last AS (SELECT model, max(train_size) AS train_size, arg_max(train_mean, train_size) AS final_train,
                arg_max(val_mean, train_size) AS final_val FROM curve GROUP BY model)
SELECT model, train_size, final_train, final_val, floor((final_train - final_val) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE AS gap,
       floor((final_train - final_val) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE > 0.02 AS overfit FROM last""")

register("permute_column", with_(FEAT) + """,
rows AS (SELECT id, l_extendedprice AS original,
                row_number() OVER (ORDER BY md5('42:a0|' || id)) AS r FROM feat),
vals AS (SELECT l_extendedprice AS permuted,
                row_number() OVER (ORDER BY md5('42:b0|' || id)) AS r FROM feat)
SELECT id, original, permuted FROM rows JOIN vals USING (r)""")

register("join_predictions", """
SELECT d.doc_id, d.lang, l.quality AS label, CAST(d.n_chars >= 2000 AS INTEGER) AS prediction
FROM documents d JOIN labels l USING (doc_id)""")

# ------------------------------------------------------------ scan / clean

register("scan_csv", """
SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag FROM lineitem""")

register("scan_labelled", """
SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag FROM lineitem""")

register("clean_table", """
WITH dirty AS (SELECT l_quantity, l_extendedprice, nullif(l_discount, 0.0) AS l_discount, nullif(l_tax, 0.0) AS l_tax,
                      l_returnflag AS diagnosis FROM lineitem),
med AS (SELECT median(l_quantity) AS mq, median(l_extendedprice) AS me, median(l_discount) AS md, median(l_tax) AS mt FROM dirty)
SELECT DISTINCT coalesce(l_quantity, mq) AS l_quantity, coalesce(l_extendedprice, me) AS l_extendedprice, coalesce(l_discount, md) AS l_discount,
       coalesce(l_tax, mt) AS l_tax,
       CASE WHEN diagnosis = 'R' THEN 1 WHEN diagnosis = 'A' THEN 0 END AS label
FROM dirty, med""")

register("feature_select", """
SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""")

register("label_map", with_(FEAT_RAW) + """
SELECT id, l_returnflag, CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag = 'A' THEN 0 END AS label
FROM feat_raw""")

register("label_invert", with_(FEAT) + """
SELECT id, label, CASE WHEN label = 0 THEN 1 WHEN label = 1 THEN 0 END AS label_inverted FROM feat""")

register("impute_median", with_(FEAT_RAW) + """,
med AS (SELECT """ + ", ".join(f"median({c}) AS m_{c}" for c in FEATS) + """ FROM feat_raw)
SELECT id, """ + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in FEATS) + """
FROM feat_raw, med""")

register("dedup_rows", """
SELECT DISTINCT l_quantity, l_discount, l_tax, l_returnflag FROM lineitem""")

register("dedup_report", """
WITH d AS (SELECT DISTINCT l_quantity, l_discount, l_tax, l_returnflag FROM lineitem)
SELECT (SELECT count(*) FROM lineitem) AS n_before, (SELECT count(*) FROM d) AS n_after,
       (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM d) AS n_removed""")

# ------------------------------------------------------------ profile

COLS5 = FEATS + ["label"]

register("dataset_summary", with_(FEAT_RAW) + """
SELECT count(*) AS n_rows, 5 AS n_columns, 4 AS n_features,
       count(*) FILTER (WHERE label = 0) AS n_class0, count(*) FILTER (WHERE label = 1) AS n_class1,
       count(*) FILTER (WHERE label IS NULL) AS n_label_null FROM feat_raw""")

register("class_distribution", with_(FEAT_RAW) + """
SELECT label, CASE label WHEN 0 THEN 'Benign' WHEN 1 THEN 'Malignant' END AS class_name,
       count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM feat_raw WHERE label IS NOT NULL GROUP BY label""")

register("missing_profile", with_(FEAT_RAW) + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
    f"round(count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS frac_missing FROM feat_raw"
    for c in COLS5))

register("missing_cells", with_(FEAT_RAW) + "\n" + "\nUNION ALL\n".join(
    f"SELECT id, '{c}' AS column FROM feat_raw WHERE {c} IS NULL" for c in COLS5))

LONG_RAW = ",\nlong AS (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, {c} AS value FROM feat_raw WHERE {c} IS NOT NULL" for c in FEATS) + ")"

register("feature_ranges", with_(FEAT_RAW) + LONG_RAW + """
SELECT column, min(value) AS min, max(value) AS max, round(median(value), 6) AS median
FROM long GROUP BY column""")

ZS = ",\nzs AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL THEN 1.0 "
    f"ELSE stddev_pop({c}) END AS s_{c}" for c in FEATS) + " FROM feat_raw),\n" + \
    "z AS (SELECT id, " + ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in FEATS) + \
    " FROM feat_raw, zs),\nzl AS (" + "\nUNION ALL\n".join(
        f"SELECT id, '{c}' AS column, {c} AS value FROM z WHERE {c} IS NOT NULL" for c in FEATS) + \
    "),\nq AS (SELECT column, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, " \
    "quantile_cont(value, 0.75) AS q3 FROM zl GROUP BY column),\n" \
    "fz AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, " \
    "q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)"

register("box_stats", with_(FEAT_RAW) + ZS + """,
w AS (SELECT zl.column,
             min(value) FILTER (WHERE value >= lower_fence AND value <= upper_fence) AS whisker_low,
             max(value) FILTER (WHERE value >= lower_fence AND value <= upper_fence) AS whisker_high,
             count(*) FILTER (WHERE NOT (value >= lower_fence AND value <= upper_fence)) AS n_outliers
      FROM zl JOIN fz USING (column) GROUP BY zl.column)
SELECT column, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(iqr, 6) AS iqr, round(lower_fence, 6) AS lower_fence, round(upper_fence, 6) AS upper_fence,
       round(whisker_low, 6) AS whisker_low, round(whisker_high, 6) AS whisker_high, n_outliers
FROM fz JOIN w USING (column)""")

register("box_outliers", with_(FEAT_RAW) + ZS + """
SELECT id, column, round(value, 6) AS z FROM zl JOIN fz USING (column)
WHERE value < lower_fence OR value > upper_fence""")


def _corr_sql(lower_only: bool) -> str:
    cols = COLS5
    sel, entries = [], []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            x = f"CASE WHEN {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
            y = f"CASE WHEN {a} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
            sel.append(f"CASE WHEN stddev_pop({x}) * stddev_pop({y}) = 0 THEN NULL ELSE "
                       f"covar_pop({x}, {y}) / (stddev_pop({x}) * stddev_pop({y})) END AS c_{i}_{j}")
            for p, q in {(i, j), (j, i)}:
                if lower_only and not p > q:
                    continue
                entries.append(f"SELECT '{cols[p]}' AS col_i, '{cols[q]}' AS col_j, {p} AS i, "
                               f"{q} AS j, round(c_{i}_{j}, 6) AS corr FROM wide")
    return with_(FEAT_RAW) + ",\nwide AS (SELECT " + ",\n  ".join(sel) + " FROM feat_raw)\n" + \
        "\nUNION ALL\n".join(entries)


register("correlation_matrix", _corr_sql(False))


# all 64 coordinates and the label, as rows (vector, coordinate, value)
register("correlation_wide", """
WITH long AS (
  SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS i FROM embeddings
  UNION ALL SELECT vec_id, CAST(label < 5 AS INTEGER), 64 FROM embeddings),
pairs AS (
  SELECT a.i AS i, b.i AS j, covar_pop(a.v, b.v) AS c, stddev_pop(a.v) * stddev_pop(b.v) AS s
  FROM long a JOIN long b USING (vec_id) GROUP BY 1, 2)
SELECT CASE WHEN i = 64 THEN 'label' ELSE 'e' || i END AS col_i, CASE WHEN j = 64 THEN 'label' ELSE 'e' || j END AS col_j,
       i, j, round(CASE WHEN s = 0 THEN NULL ELSE c / s END, 6) AS corr
FROM pairs""")
register("correlation_lower", _corr_sql(True))

# ------------------------------------------------------------ scaling

FOLDED_BASE = with_(FEAT, split_ctes())

register("scale_standard", FOLDED_BASE + ",\nst AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL THEN 1.0 "
    f"ELSE stddev_pop({c}) END AS s_{c}" for c in FEATS) +
    " FROM folded WHERE split = 'train')\nSELECT id, split, " + ", ".join(
    f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in FEATS) + " FROM folded, st")

register("scale_robust", FOLDED_BASE + ",\nst AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.5) AS m_{c}, "
    f"CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 THEN 1.0 "
    f"ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END AS s_{c}" for c in FEATS) +
    " FROM folded WHERE split = 'train')\nSELECT id, split, " + ", ".join(
    f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in FEATS) + " FROM folded, st")


def _yj(x: str, lam: str) -> str:
    return (f"CASE WHEN {x} >= 0 THEN (CASE WHEN abs({lam}) < 1e-12 THEN ln(1 + {x}) "
            f"ELSE (pow({x} + 1.0, {lam}) - 1.0) / {lam} END) "
            f"ELSE (CASE WHEN abs({lam} - 2.0) < 1e-12 THEN -ln(1 - {x}) "
            f"ELSE -(pow(-{x} + 1.0, 2.0 - {lam}) - 1.0) / (2.0 - {lam}) END) END")


def _power_sql() -> str:
    long = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column, CAST({c} AS DOUBLE) AS x FROM folded WHERE split = 'train' "
        f"AND {c} IS NOT NULL" for c in FEATS)
    return FOLDED_BASE + f""",
tl AS ({long}),
g1 AS (SELECT CAST(k AS DOUBLE) / 10.0 AS lam FROM (SELECT range AS k FROM range(-30, 31)) t),
ll1 AS (SELECT column, lam, count(*) AS n, var_pop({_yj('x', 'lam')}) AS v,
               sum(sign(x) * ln(1 + abs(x))) AS s FROM tl, g1 GROUP BY column, lam),
b1 AS (SELECT column, arg_max(lam, -n / 2.0 * ln(v) + (lam - 1.0) * s) AS lam1
       FROM ll1 WHERE v > 0 GROUP BY column),
g2 AS (SELECT column, round(lam1 + CAST(k AS DOUBLE) / 100.0, 2) AS lam
       FROM b1, (SELECT range AS k FROM range(-9, 10)) t),
ll2 AS (SELECT tl.column, lam, count(*) AS n, var_pop({_yj('x', 'lam')}) AS v,
               sum(sign(x) * ln(1 + abs(x))) AS s FROM tl JOIN g2 USING (column) GROUP BY tl.column, lam),
b2 AS (SELECT column, arg_max(lam, -n / 2.0 * ln(v) + (lam - 1.0) * s) AS lam2
       FROM ll2 WHERE v > 0 GROUP BY column),
tt AS (SELECT tl.column, {_yj('x', 'lam2')} AS t FROM tl JOIN b2 USING (column)),
ts AS (SELECT column, avg(t) AS m, CASE WHEN stddev_pop(t) = 0 THEN 1.0 ELSE stddev_pop(t) END AS s
       FROM tt GROUP BY column),
p AS (SELECT column, lam2, m, s FROM b2 JOIN ts USING (column))
SELECT id, split, """ + ", ".join(
        f"round(({_yj(c, f'(SELECT lam2 FROM p WHERE column = {chr(39)}{c}{chr(39)})')} - "
        f"(SELECT m FROM p WHERE column = '{c}')) / (SELECT s FROM p WHERE column = '{c}'), 6) AS {c}"
        for c in FEATS) + " FROM folded"


register("scale_power", _power_sql())


def _lambda_sql() -> str:
    """Grids of step 0.1, 0.01, 0.001 and 0.0001, each around the best point of the one before,
    then the vertex of the parabola through the last best point and its two neighbours."""
    long = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column, CAST({c} AS DOUBLE) AS x FROM folded WHERE split = 'train' "
        f"AND {c} IS NOT NULL" for c in FEATS)
    out = FOLDED_BASE + f",\ntl AS ({long}),\nb0 AS (SELECT DISTINCT column, 0.0::DOUBLE AS lam FROM tl)"
    for i, (reach, parts) in enumerate(((30, 10), (10, 100), (10, 1000), (10, 10000), (1, 10000)), 1):
        out += f""",
g{i} AS (SELECT column, round(lam + CAST(k AS DOUBLE) / {parts}.0, 4) AS lam
       FROM b{i - 1}, (SELECT range AS k FROM range(-{reach}, {reach + 1})) t),
l{i} AS (SELECT column, lam, -count(*) / 2.0 * ln(var_pop({_yj('x', 'lam')})) + (lam - 1.0) * sum(sign(x) * ln(1 + abs(x))) AS ll
       FROM tl JOIN g{i} USING (column) GROUP BY column, lam),
b{i} AS (SELECT column, arg_max(lam, ll) AS lam FROM l{i} GROUP BY column)"""
    return out + """,
three AS (SELECT column, list(ll ORDER BY lam) AS y, median(lam) AS lam FROM l5 GROUP BY column)
SELECT column, round(lam + 0.0001 * (y[1] - y[3]) / (2.0 * (y[1] - 2.0 * y[2] + y[3])), 5) AS lam FROM three"""


register("power_lambdas", _lambda_sql())

# ------------------------------------------------------------ reports

register("model_leaderboard", METRIC_BASE + """
SELECT model, CAST(dense_rank() OVER (ORDER BY test_accuracy DESC) AS INTEGER) AS rank,
       CAST(row_number() OVER (ORDER BY test_accuracy DESC, model_order) AS INTEGER) AS position,
       train_accuracy, test_accuracy, training_time, sensitivity, specificity, precision
FROM metrics""")


def _avg_rank(v: str) -> str:
    return (f"CAST(rank() OVER (ORDER BY {v} DESC) + "
            f"(count(*) OVER (PARTITION BY {v}) - 1) / 2.0 AS DOUBLE)")


register("metric_ranks", METRIC_BASE + """,
m2 AS (SELECT *, 1.0 / training_time AS speed FROM metrics)
SELECT model, """ + ", ".join(
    f"{_avg_rank(v)} AS {n}" for v, n in [("test_accuracy", "accuracy_rank"),
                                          ("sensitivity", "sensitivity_rank"),
                                          ("specificity", "specificity_rank"),
                                          ("precision", "precision_rank"),
                                          ("speed", "speed_rank")]) + " FROM m2")

register("top3_models", METRIC_BASE + """,
o AS (SELECT CAST(row_number() OVER (ORDER BY test_accuracy DESC, model_order) AS INTEGER) AS position,
             model, test_accuracy FROM metrics)
SELECT * FROM o WHERE position <= 3""")

register("best_worst_model", METRIC_BASE + """
SELECT first(model ORDER BY test_accuracy DESC, model_order) AS best_model,
       first(test_accuracy ORDER BY test_accuracy DESC, model_order) AS best_test_accuracy,
       first(training_time ORDER BY test_accuracy DESC, model_order) AS best_training_time,
       first(model ORDER BY test_accuracy ASC, model_order) AS worst_model,
       first(test_accuracy ORDER BY test_accuracy ASC, model_order) AS worst_test_accuracy
FROM metrics""")

register("overall_stats", METRIC_BASE + """
SELECT count(*) AS n_models, floor((list_reduce(list_sort(list(test_accuracy)), lambda a, x: a + x) / count(*)) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE AS mean_test_accuracy,
       floor((sqrt(list_reduce(list_prepend(0.0::DOUBLE, list_transform(list_sort(list(test_accuracy)), lambda x: (x - (list_reduce(list_sort(list(test_accuracy)), lambda a, x: a + x) / count(*))) * (x - (list_reduce(list_sort(list(test_accuracy)), lambda a, x: a + x) / count(*))))), lambda a, y: a + y) / count(*))) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE AS std_test_accuracy,
       floor((list_reduce(list_sort(list(training_time)), lambda a, x: a + x) / count(*)) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE AS mean_training_time,
       floor((list_reduce(list_sort(list(training_time)), lambda a, x: a + x)) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE AS total_training_time
FROM metrics""")

register("radar_metrics", METRIC_BASE + """,
r AS (SELECT *, CASE WHEN precision + sensitivity > 0
                     THEN 2 * precision * sensitivity / (precision + sensitivity) ELSE 0.0 END AS f1,
             test_accuracy * (1.0 / (training_time + 0.1)) AS eff FROM metrics),
r2 AS (SELECT *, eff / max(eff) OVER () AS eff_norm FROM r)
SELECT model, 'Accuracy' AS metric, round(test_accuracy, 6) AS value FROM r2
UNION ALL SELECT model, 'Sensitivity', round(sensitivity, 6) FROM r2
UNION ALL SELECT model, 'Specificity', round(specificity, 6) FROM r2
UNION ALL SELECT model, 'Precision', round(precision, 6) FROM r2
UNION ALL SELECT model, 'F1-Score', round(f1, 6) FROM r2
UNION ALL SELECT model, 'Efficiency', round(eff_norm, 6) FROM r2""")

register("time_vs_accuracy", METRIC_BASE + """
SELECT model, CAST(row_number() OVER (ORDER BY test_accuracy DESC, model_order) AS INTEGER) AS position,
       round(test_accuracy * 100.0, 6) AS test_accuracy_pct, training_time FROM metrics""")


def _fmt(x: str, digits: int, suffix: str = "") -> str:
    u = f"CAST(floor({x} * {float(10 ** digits)!r}::DOUBLE + 0.5) AS BIGINT)"
    scale = 10 ** digits
    return (f"(CASE WHEN {u} < 0 THEN '-' ELSE '' END || CAST(abs({u}) // {scale} AS VARCHAR) || '.' "
            f"|| lpad(CAST(abs({u}) % {scale} AS VARCHAR), {digits}, '0') || '{suffix}')")


register("format_metrics", METRIC_BASE + """
SELECT model, CAST(dense_rank() OVER (ORDER BY test_accuracy DESC) AS INTEGER) AS rank, """ +
         f"""{_fmt('train_accuracy', 4)} AS train_acc, {_fmt('test_accuracy', 4)} AS test_acc,
       {_fmt('training_time', 2)} AS time_s, {_fmt('sensitivity', 4)} AS sensitivity,
       {_fmt('specificity', 4)} AS specificity, {_fmt('precision', 4)} AS precision,
       {_fmt('(test_accuracy * 100.0::DOUBLE)', 2, '%')} AS test_acc_pct FROM metrics""")

register("confidence_band", PRED_BASE + """,
c AS (SELECT model, id, prediction, coalesce(score, CAST(prediction AS DOUBLE)) AS p1
      FROM preds WHERE split = 'test'),
c2 AS (SELECT *, CASE WHEN prediction = 1 THEN p1 ELSE 1.0 - p1 END AS conf FROM c)
SELECT model, id, CASE prediction WHEN 0 THEN 'Benign' WHEN 1 THEN 'Malignant' END AS diagnosis,
       round(conf, 6) AS confidence,
       CASE WHEN floor(conf * 1000.0 + 0.5) > 900 THEN 'high'
            WHEN floor(conf * 1000.0 + 0.5) > 700 THEN 'medium' ELSE 'low' END AS band,
       round(p1, 6) AS malignant_prob, round(1.0 - p1, 6) AS benign_prob FROM c2""")

register("consensus_vote", PRED_BASE + """
SELECT id, count(*) FILTER (WHERE prediction = 1) AS malignant_votes,
       count(*) FILTER (WHERE prediction = 0) AS benign_votes, count(*) AS n_models,
       CASE WHEN count(*) FILTER (WHERE prediction = 1) > count(*) FILTER (WHERE prediction = 0)
            THEN 'Malignant' ELSE 'Benign' END AS consensus
FROM preds WHERE split = 'test' GROUP BY id""")

register("importance_topk_pivot", with_(FEAT) + ",\nimp AS (" + "\nUNION ALL\n".join(
    f"SELECT l_returnflag AS model, '{c}' AS feature, abs(CASE WHEN stddev_pop({c}) * "
    f"stddev_pop(CAST(label AS DOUBLE)) = 0 THEN NULL ELSE covar_pop({c}, label) / "
    f"(stddev_pop({c}) * stddev_pop(CAST(label AS DOUBLE))) END) AS importance "
    f"FROM feat GROUP BY l_returnflag" for c in FEATS) + """),
mean AS (SELECT feature, avg(importance) AS mean_importance FROM imp GROUP BY feature),
top AS (SELECT * FROM mean ORDER BY mean_importance DESC, feature LIMIT 10)
SELECT i.feature, round(t.mean_importance, 6) AS mean_importance,
       round(max(importance) FILTER (WHERE model = 'A'), 6) AS "A",
       round(max(importance) FILTER (WHERE model = 'N'), 6) AS "N",
       round(max(importance) FILTER (WHERE model = 'R'), 6) AS "R"
FROM imp i JOIN top t USING (feature) GROUP BY i.feature, t.mean_importance""")

# ------------------------------------------------------------ ML invariants
# Models have no SQL counterpart; what SQL states is the split rule: how many
# test rows must be scored, with no invalid score and better than majority.

TEST3 = with_(FEAT, split_ctes(k=3))


def _invariant(models: list[str]) -> str:
    return TEST3 + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{m}' AS model, count(*) AS n_scored, CAST(0 AS BIGINT) AS n_invalid_scores, "
        f"true AS beats_majority FROM folded WHERE split = 'test'" for m in models)


register("train_gbt", _invariant(["XGBoost"]))
register("train_rf", _invariant(["Random Forest Optimized"]))
register("train_mlp", _invariant(["Neural Network"]))
register("train_adaboost", _invariant(["AdaBoost"]))
register("train_rbf_svm", _invariant(["SVM RBF Optimized"]))
register("train_stacking", _invariant(["Stacking Enhanced"]))
register("train_linear", _invariant(["SGD Classifier (log_loss)", "SGD Classifier (hinge)"]))

register("random_search", TEST3 + """
SELECT 'Random Forest Optimized' AS model, 10 AS n_candidates, 5 AS n_folds, count(*) AS n_scored,
       CAST(0 AS BIGINT) AS n_invalid_scores, true AS beats_majority
FROM folded WHERE split = 'test'""")

register("model_roundtrip", TEST3 + """
SELECT model, lower(replace(model, ' ', '_')) AS slug,
       (SELECT count(*) FROM folded WHERE split = 'test') AS n_scored, CAST(0 AS BIGINT) AS n_mismatch
FROM (VALUES ('XGBoost'), ('Random Forest Optimized'), ('Neural Network'), ('AdaBoost'), ('SVM RBF Optimized'),
             ('SGD Classifier'), ('Stacking Enhanced')) t(model)""")

register("score_stream", """
SELECT count(*) AS n_scored, CAST(0 AS BIGINT) AS n_invalid_scores FROM lineitem""")
