"""Language by Bayesian fusion of text, declared language, address suffix and host.

The text's likelihood under each language comes from hashed character trigrams
(three bytes), counted over all training texts, once in each, so that no long or
repetitive text speaks for its language alone. What a declared language or an
address suffix says is learned from the records themselves: how often each
value goes with the language that the texts point to. A host's prior is smoothed
towards its domain's, that towards its suffix's and that towards the global
one, all from grouped sums of the texts' posteriors, without the record's own.

Everything per record is a map; the groups are sums combined before the shuffle
and joined back, so a host with a third of all records is a skewed join's key
and no task's group.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import stored
from .suffix_refine import _bytes

#: Buckets of the hashed trigrams.
BUCKETS = 1 << 15
SLICE = 1 << 20


def trigrams(values: np.ndarray) -> np.ndarray:
    """Bucket of the three bytes at each place; ASCII letters in lower case, everything below letters a space."""
    folded = _FOLD[values].astype(np.uint32)
    code = (folded[:-2] << np.uint32(16)) | (folded[1:-1] << np.uint32(8)) | folded[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


def _fold() -> np.ndarray:
    out = np.full(256, 32, np.uint8)
    out[128:] = np.arange(128, 256)
    for c in range(26):
        out[97 + c] = out[65 + c] = 97 + c
    return out


_FOLD = _fold()


def _slices(column: pa.Array):
    """(first row, number of rows, trigram buckets, row of each, trigrams per row) for slices of a text column."""
    values, offsets = _bytes(column.fill_null(""))
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
        data = values[offsets[at]:offsets[to]]
        ends = offsets[at + 1:to + 1] - offsets[at]
        if len(data) > 2:
            codes = trigrams(data)
            row = np.repeat(np.arange(to - at), np.diff(ends, prepend=0))[:-2]
            inside = np.arange(2, len(data)) < ends[row]
            # runs of separators say nothing
            plain = _FOLD[data]
            inside &= (plain[1:-1] != 32) | (plain[2:] != 32) & (plain[:-2] != 32)
            codes, row = codes[inside], row[inside]
        else:
            codes = row = np.zeros(0, np.int64)
        yield at, to - at, codes, row, np.bincount(row, minlength=to - at)
        at = to


def learn(texts: DataFrame, text_col: str, lang_col: str, smoothing: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Languages and their log trigram probabilities (languages x buckets), counted over all rows with a language.

    A trigram's count is the number of texts that hold it. Rows without a language or text teach nothing."""
    rows = texts.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            names, which = np.unique(langs.astype(str), return_inverse=True)
            for at, n, codes, row, _ in _slices(batch.column(1)):
                once = np.unique(row * BUCKETS + codes)
                own_lang = which[at:at + n][once // BUCKETS]
                c = np.bincount(own_lang * BUCKETS + once % BUCKETS, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
                for name, own in zip(names, c):
                    total[name] = total.get(name, 0) + own
        for name, own in total.items():
            place = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([str(name)] * len(place), pa.string()), pa.array(place, pa.int32()),
                                              pa.array(own[place], pa.int64())], names=["lang", "bucket", "n"])
        pa.default_memory_pool().release_unused()  # the worker lives on

    counted = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # at most BUCKETS numbers for each language
    found = counted.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts")).collect()
    langs = sorted(r["lang"] for r in found)
    table = np.full((len(langs), BUCKETS), smoothing)
    for r in found:
        place, n = np.array(r["counts"], np.int64).T
        table[langs.index(r["lang"]), place] += n
    return langs, np.log(table / table.sum(axis=1, keepdims=True)) if langs else table


def host_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, domain (its last two labels) and suffix of an address."""
    host = F.nullif(F.lower(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    return host, F.regexp_extract(host, r"([^.]+\.)?[^.]*$", 0), F.nullif(F.regexp_extract(host, r"\.([^.]+)$", 1), F.lit(""))


def declared_language(html: Column) -> Column:
    """The primary language subtag that a page's html element declares."""
    return F.nullif(F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})\b", 1)), F.lit(""))


#: Columns that ``identify`` adds.
JUDGED = ("lang_text", "language", "confidence", "evidence", "gain")


def identify(records: DataFrame, langs: list[str], table: np.ndarray, temper: float = 60.0, weight: float = 20.0, trust: float = 0.5) -> DataFrame:
    """Adds ``lang_text`` (by text alone), ``language``, ``confidence``, ``evidence`` and ``gain`` to ``records``.

    ``records`` has the columns key, text, declared, suffix, domain, host (each may be
    null; null evidence says nothing) and any others; one named like an added column is
    replaced by it. ``temper``: a text counts as at most
    so many independent trigrams. ``weight``: records that a group's parent counts as.
    ``evidence`` is the number of trigrams, ``gain`` how much likelier the best language makes
    one than chance does (natural logarithm; 0 without text). A null, empty or wordless text is judged by the
    rest. Without languages ``language`` is null and ``confidence`` 0. Repeated rows are
    rows of their own. Records may be those that taught ``table``: a declared language
    then speaks twice, through the table and as evidence.

    Work and plan grow with the number of languages, not its square; a language takes
    256 kB of the driver and of each Python worker.
    """
    if not langs:
        return records.drop("text").withColumns({"lang_text": F.lit(None).cast("string"), "language": F.lit(None).cast("string"),
                                                 "confidence": F.lit(0.0), "evidence": F.lit(0).cast("long"), "gain": F.lit(0.0)})
    n, spark = len(langs), records.sparkSession
    rest = [c for c in records.columns if c != "text"]
    packed = records.select(F.struct(*rest).alias("rest"), "text")
    numbers = T.ArrayType(T.DoubleType())
    schema = T.StructType([packed.schema["rest"], T.StructField("ll", numbers), T.StructField("p", numbers), T.StructField("evidence", T.LongType())])
    shared = spark.sparkContext.broadcast(table)

    def lists(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * n, pa.int32()), pa.array(values.ravel()))

    def score(batches):
        table = shared.value
        for batch in batches:
            ll, evidence = np.zeros((batch.num_rows, n)), np.zeros(batch.num_rows, np.int64)
            for at, k, codes, row, each in _slices(batch.column(1)):
                evidence[at:at + k] = each
                for i in range(n):
                    ll[at:at + k, i] = np.bincount(row, table[i][codes], k)
            ll *= (np.minimum(evidence, temper) / np.maximum(evidence, 1))[:, None]
            p = np.exp(ll - ll.max(axis=1, keepdims=True, initial=-np.inf)) * (evidence > 0)[:, None]
            p /= np.maximum(p.sum(axis=1, keepdims=True), 1e-300)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(ll), lists(p), pa.array(evidence)], names=schema.fieldNames())
        pa.default_memory_pool().release_unused()

    rows = stored(packed.mapInArrow(score, schema), "language-scores")
    shared.destroy()  # the scores are written
    sums = F.array(*[F.coalesce(F.sum(F.get("p", F.lit(i))), F.lit(0.0)) for i in range(n)])
    whole = np.array(rows.agg(sums.alias("sums")).first().sums)  # one number for each language

    keys = ("suffix", "domain", "host", "declared")
    joined = rows
    for key in keys:
        name = F.col("rest").getField(key)
        group = rows.where(name.isNotNull()).groupBy(name.alias("of")).agg(sums.alias(key))
        group = stored(group, f"{key}-sums")
        joined = joined.join(group, name == group["of"], "left").drop("of")
    joined = joined.withColumn("said", F.col("rest").getField("declared").isNotNull())
    out = T.StructType([packed.schema["rest"], *[T.StructField(c, t) for c, t in zip(JUDGED, (
        T.StringType(), T.StringType(), T.DoubleType(), T.LongType(), T.DoubleType()))]])

    def others(column: pa.Array, p: np.ndarray) -> np.ndarray:
        """A group's sums without the record's own share; 0 where the record has no group."""
        found = np.zeros(p.shape)
        known = column.is_valid().to_numpy(zero_copy_only=False)
        found[known] = column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
        return np.maximum(found - p, 0.0) * known[:, None]

    def fuse(batches):
        mass, names = whole.sum(), pa.array(langs, pa.string())
        for batch in batches:
            ll, p = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, n) for c in (1, 2))
            evidence = batch.column(3).to_numpy()
            prior = (whole + 1.0) / (mass + n)
            for c in (4, 5, 6):  # suffix, domain, host, each smoothed towards the one before
                own = others(batch.column(c), p)
                prior = (own + weight * prior) / (own.sum(axis=1, keepdims=True) + weight)
            # how often texts of the language go with what is declared, against how often any text does
            said = others(batch.column(7), p)
            base = (said.sum(axis=1, keepdims=True) + 1.0) / (mass + 1.0)
            likelihood = (said + weight * base * 0.5) / (whole + weight * 0.5)
            z = ll + np.log(prior) + trust * np.log(likelihood) * batch.column(8).to_numpy(zero_copy_only=False)[:, None]
            some = evidence > 0
            by_text = pa.array(ll.argmax(axis=1), mask=~some)
            odds = np.exp(z - z.max(axis=1, keepdims=True, initial=-np.inf)).sum(axis=1)
            gain = np.where(some, ll.max(axis=1, initial=-np.inf) / np.clip(evidence, 1, temper) + np.log(BUCKETS), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), names.take(by_text), names.take(pa.array(z.argmax(axis=1))), pa.array(1.0 / odds),
                 batch.column(3), pa.array(gain)], names=out.fieldNames())

    judged = joined.select("rest", "ll", "p", "evidence", *keys, "said").mapInArrow(fuse, out)
    return judged.select(*[F.col("rest").getField(c).alias(c) for c in rest if c not in JUDGED], *JUDGED)


def accepted(confidence: float = 0.5) -> Column:
    """Whether a judged record has a language: enough confidence, and text that fits it better than chance."""
    return F.coalesce((F.col("confidence") >= confidence) & (F.col("gain") > 0), F.lit(False))
