"""Column-expression helpers. All are built-in Spark expressions (JVM side,
whole-stage codegen); none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference application (class names, label codes,
# confidence bands, efficiency offset, overfit threshold).
CLASS_NAMES = ("Benign", "Malignant")
LABEL_CODES = {"M": 1, "B": 0}
BAND_HIGH = 0.9
BAND_MEDIUM = 0.7
EFFICIENCY_OFFSET = 0.1
OVERFIT_GAP = 0.02


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den, zero=None) -> Column:
    """num / den, NULL (or ``zero``) when den is 0 or NULL. ANSI-safe."""
    q = F.try_divide(col_(num).cast("double"), col_(den).cast("double"))
    return q if zero is None else F.coalesce(q, F.lit(float(zero)))


def nan_to_null(c) -> Column:
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def value_map(c, mapping: dict, default=None) -> Column:
    """Map values through a dict; unmatched values become ``default`` (NULL)."""
    c = col_(c)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c == F.lit(k), F.lit(v)) if expr is None
                else expr.when(c == F.lit(k), F.lit(v)))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def md5_key(*cols, seed: int | str = 42) -> Column:
    """Deterministic per-row hash key: md5('<seed>:' || key). Same value in
    any engine that implements md5, so samplers are reproducible and
    independent of partitioning or row order."""
    parts = [F.coalesce(col_(c).cast("string"), F.lit("")) for c in cols]
    key = parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)
    return F.md5(F.concat(F.lit(f"{seed}:"), key))


def hex_bucket(h, digits: int) -> Column:
    """Leading ``digits`` hex characters of an md5 string as a bigint bucket.
    md5 is uniform, so buckets are equal-sized by construction."""
    return F.conv(F.substring(col_(h), 1, digits), 16, 10).cast("bigint")


def binary_bucket(h, digits: int) -> Column:
    """``hex_bucket`` of an md5 key kept as its 16 bytes."""
    return F.conv(F.substring(F.hex(F.substring(col_(h), 1, (digits + 1) // 2)), 1, digits), 16, 10).cast("bigint")


def f1_expr(p, r) -> Column:
    p, r = col_(p), col_(r)
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def half_up_units(x, digits: int) -> Column:
    """floor(x * 10^digits + 0.5) as bigint: an engine-independent rounding
    (pure IEEE arithmetic), used before any formatting or banding."""
    return F.floor(col_(x) * F.lit(float(10 ** digits)) + F.lit(0.5)).cast("bigint")


def fmt_fixed(x, digits: int, suffix: str = "") -> Column:
    """Fixed-point text of x with ``digits`` decimals, built from integer
    arithmetic so the text is identical in every engine."""
    units = half_up_units(x, digits)
    sign = F.when(units < 0, F.lit("-")).otherwise(F.lit(""))
    a = F.abs(units)
    if digits == 0:
        body = a.cast("string")
    else:
        scale = F.lit(10 ** digits).cast("bigint")
        ip = ((a - F.pmod(a, scale)) / scale).cast("bigint")
        fp = F.lpad(F.pmod(a, scale).cast("string"), digits, "0")
        body = F.concat(ip.cast("string"), F.lit("."), fp)
    return F.concat(sign, body, F.lit(suffix))


def fmt_percent(x, digits: int) -> Column:
    """Python's f'{x:.{digits}%}' on a value rounded half-up first."""
    return fmt_fixed(col_(x) * F.lit(100.0), digits, "%")


def class_name(label, names=CLASS_NAMES) -> Column:
    """Class index -> display name (NULL for unknown index)."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), col_(label).cast("int") + 1)


def confidence(prediction, score) -> Column:
    """Probability of the predicted class; one-hot when no probability."""
    pred, sc = col_(prediction), col_(score)
    p1 = F.coalesce(sc, pred.cast("double"))
    return F.when(pred == 1, p1).otherwise(F.lit(1.0) - p1)


def confidence_band(conf) -> Column:
    """Band on the displayed value (rounded to 0.1 %): >90 % high, >70 % medium."""
    permille = half_up_units(conf, 3)
    return (F.when(permille > int(BAND_HIGH * 1000), F.lit("high"))
            .when(permille > int(BAND_MEDIUM * 1000), F.lit("medium"))
            .otherwise(F.lit("low")))


def slug(name) -> Column:
    """Model file name: lower case, blanks to underscores."""
    return F.replace(F.lower(col_(name)), F.lit(" "), F.lit("_"))


def round6(x) -> Column:
    """floor(x * 1e6 + 0.5) / 1e6: pure IEEE arithmetic, so two engines that
    hold the same double print the same rounded value (no decimal-repr ties)."""
    return F.floor(col_(x) * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def ordered_mean(c) -> Column:
    """Mean over a small group (folds, models) as a left fold over the sorted
    values: the same operations in the same order on every engine and every
    partitioning. The group is collected, so use it only where the group size
    is bounded by a parameter."""
    arr = F.array_sort(F.collect_list(col_(c)))
    return F.aggregate(arr, F.lit(0.0), lambda a, v: a + v) / F.size(arr)


def ordered_std_pop(c) -> Column:
    """Population std over a small group, two-pass on the sorted values."""
    arr = F.array_sort(F.collect_list(col_(c)))
    m = F.aggregate(arr, F.lit(0.0), lambda a, v: a + v) / F.size(arr)
    ss = F.aggregate(arr, F.lit(0.0), lambda a, v: a + (v - m) * (v - m))
    return F.sqrt(ss / F.size(arr))
