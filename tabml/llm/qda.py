"""Document quality by a regularised quadratic discriminant.

Every text gets a vector of transformed statistics. Each class is a Gaussian
over them; its covariance is shrunk towards the pooled one and that towards its
diagonal. A score is the logistic of the difference of the two log densities,
which are Mahalanobis distances by way of a Cholesky factor of each class,
computed once, and of the log priors.

Counts, sums and products of the training rows are added up in the tasks, so
all labelled rows are used and the driver gets one small matrix per class.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import stored
from .suffix_refine import _bytes

#: Classes of bytes that are counted.
LOWER, UPPER, DIGIT, SPACE, LINE, STOP, MARK, OTHER, WIDE, TAIL = range(10)


def _classes() -> np.ndarray:
    out = np.full(256, OTHER)
    for c, chars in ((LOWER, "abcdefghijklmnopqrstuvwxyz"), (UPPER, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (DIGIT, "0123456789"),
                     (SPACE, " \t\r\f\v"), (LINE, "\n"), (STOP, ".,"), (MARK, "!?;:'\"()-")):
        out[[ord(x) for x in chars]] = c
    out[0x80:0xC0] = TAIL
    out[0xC0:] = WIDE
    return out.astype(np.uint8)


_CLASS = _classes()
NAMES = ("words", "word_length", "word_spread", "upper", "digits", "stops", "marks", "symbols", "wide", "line_length",
         "distinct_words", "distinct_lines", "capital_words", "line_stops", "symbol_words", "long_words", "doubled_words")


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics per text; those of an empty text are those of no words and no shares."""
    texts = texts.fill_null("")
    values, offsets = _bytes(texts)
    n = len(texts)
    data = values[offsets[0]:offsets[-1]]
    ends = offsets[1:] - offsets[0]
    starts = offsets[:-1] - offsets[0]
    kind = _CLASS[data]
    row = np.repeat(np.arange(n), np.diff(offsets))
    counts = np.bincount(row * 10 + kind, minlength=n * 10).reshape(n, 10).astype(float)
    chars = counts.sum(axis=1) - counts[:, TAIL]
    # capital letters of Latin-1 in UTF-8
    tall = np.append(False, (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) if len(data) else np.zeros(0, bool)
    counts[:, UPPER] += np.bincount(row[tall], minlength=n)
    gap = (kind == SPACE) | (kind == LINE)
    begin = ~gap
    if len(data):
        begin[1:] &= gap[:-1]
        first = np.zeros(len(data), bool)
        first[starts[starts < ends]] = True
        begin |= first & ~gap
    at = np.flatnonzero(begin)
    words = np.bincount(row[at], minlength=n).astype(float)
    # each word's length in bytes: up to the next gap or the text's end
    stop = np.append(np.flatnonzero(gap), len(data))
    length = np.minimum(stop[np.searchsorted(stop, at)], ends[row[at]]) - at
    per = np.maximum(words, 1)
    mean = np.bincount(row[at], length, n) / per
    spread = np.sqrt(np.maximum(np.bincount(row[at], length ** 2.0, n) / per - mean ** 2, 0))
    capital = np.bincount(row[at], (kind[at] == UPPER) | tall[np.minimum(at + 1, max(len(data) - 1, 0))], n) / per
    long = np.bincount(row[at], length > 12, n) / per
    # words that end in a symbol, lines that end in a stop
    symbol_end = np.bincount(row[at], kind[at + np.maximum(length.astype(np.int64), 1) - 1] == OTHER, n) / per if len(at) else np.zeros(n)
    brk = np.flatnonzero(kind == LINE)
    brk = brk[brk > 0]
    line_stop = np.bincount(row[brk], kind[brk - 1] == STOP, n) / np.maximum(counts[:, LINE], 1)
    distinct_words, distinct_lines, doubled = np.zeros(n), np.zeros(n), np.zeros(n)
    for i, t in enumerate(texts.to_pylist()):
        if words[i]:
            parts = t.split()
            distinct_words[i] = len(set(parts))
            doubled[i] = sum(map(eq, parts, parts[1:])) / len(parts)
        lines = t.split("\n")
        distinct_lines[i] = len(set(lines)) / len(lines)
    share = lambda c: np.sqrt(counts[:, c] / np.maximum(chars, 1))
    lines = counts[:, LINE] + 1
    return np.column_stack([
        np.log1p(words), np.log1p(mean), np.log1p(spread), share(UPPER), share(DIGIT), share(STOP), share(MARK), share(OTHER), share(WIDE),
        np.log1p(words / lines), np.log((distinct_words + 1) / (words + 1)), distinct_lines, np.sqrt(capital), line_stop, np.sqrt(symbol_end), np.sqrt(long), np.sqrt(doubled)])


def towards(x: np.ndarray, usual: np.ndarray, words: float) -> np.ndarray:
    """Statistics but the first (the length) drawn towards the usual ones, the more the fewer words a text has."""
    n = np.expm1(x[:, :1])
    out = usual + (x - usual) * np.sqrt(n / (n + words))
    out[:, 0] = x[:, 0]
    return out


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and constants of the two classes; ``None`` for a class without rows."""

    means: list
    inverse: list
    constants: list

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        if self.means[0] is None and self.means[1] is None:
            return np.full(len(x), 0.5)
        for k in (0, 1):
            if self.means[k] is None:
                return np.full(len(x), float(1 - k))
        z = [c - 0.5 * (((x - m) @ inv.T) ** 2).sum(axis=1) for m, inv, c in zip(self.means, self.inverse, self.constants)]
        return 1 / (1 + np.exp(np.clip(z[0] - z[1], -700, 700)))


def fit(counts: list, sums: list, products: list, pooled: float, diagonal: float) -> Discriminant:
    """``pooled``: share of the pooled covariance in a class's; ``diagonal``: share of its own diagonal in the sum."""
    d, total = len(sums[0]), sum(counts)
    means, scatter = [], []
    for n, s, p in zip(counts, sums, products):
        mean = s / n if n else None
        means.append(mean)
        scatter.append(p - n * np.outer(mean, mean) if n else np.zeros((d, d)))
    within = sum(scatter) / max(total, 1)
    inverse, constants = [], []
    for n, sc in zip(counts, scatter):
        if not n:
            inverse.append(None)
            constants.append(None)
            continue
        cov = (1 - pooled) * sc / n + pooled * within
        cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + 1e-6 * np.eye(d)
        factor = np.linalg.cholesky(cov)
        inverse.append(np.linalg.inv(factor))
        constants.append(float(np.log(n / total) - np.log(np.diag(factor)).sum()))
    return Discriminant(means, inverse, constants)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5, pooled: float = 0.5, diagonal: float = 0.1,
                  usual_words: float = 10, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    ``labels`` (doc_id, a 0/1 column) teaches rows whose crc32(id as text) mod ``folds`` is
    not 0; the others are held out. A null text is an empty one. Rows with a null id or
    label teach nothing; a null id counts as not held out. Of contradicting labels of an
    id the larger holds. Without rows of one class all scores are the other class's; without
    labels they are 0.5. ``usual_words``: with so many words a text's statistics count half
    (in squares), the usual text's the rest. Other columns are not read.
    """
    d = len(NAMES)
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType
    vector = T.StructType([T.StructField("doc_id", kind), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def describe(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                x = statistics(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * d, pa.int32()), pa.array(x.ravel()))], names=["doc_id", "x"])

    x = stored(plain.mapInArrow(describe, vector), "statistics")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    known = (labels.select(F.col("doc_id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    taught = x.where(~held).join(known, "doc_id").select("label", "x")

    sums = taught.groupBy("label").agg(F.count("*").alias("n"), *[F.sum(F.get("x", F.lit(i))).alias(f"x{i}") for i in range(d)]).collect()
    usual = np.zeros(d)  # the mean of class 1: what is expected of a text too short to tell
    for r in sorted(sums, key=lambda r: r["label"]):
        usual = np.array(r[2:]) / r["n"]

    def rows_of(batch, at):
        return towards(pc.list_flatten(batch.column(at)).to_numpy().reshape(-1, d), usual, usual_words)

    def add_up(batches):
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            label, rows = batch.column(0).to_numpy(), rows_of(batch, 1)
            for k in (0, 1):
                own = rows[label == k]
                total[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        place = np.arange(total.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], len(place)), pa.int32()), pa.array(np.tile(place, 2), pa.int32()),
                                          pa.array(total.ravel())], names=["label", "place", "value"])

    total = np.zeros((2, 1 + d + d * d))  # the whole of what the driver gets
    for r in taught.mapInArrow(add_up, "label int, place int, value double").groupBy("label", "place").agg(F.sum("value").alias("value")).collect():
        total[r["label"], r["place"]] = r["value"]
    model = fit([int(t[0]) for t in total], [t[1:d + 1] for t in total], [t[d + 1:].reshape(d, d) for t in total], pooled, diagonal)

    def judge(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(rows_of(batch, 1)))], names=["doc_id", "score"])

    scored = x.mapInArrow(judge, T.StructType([vector["doc_id"], T.StructField("score", T.DoubleType())]))
    return scored.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
