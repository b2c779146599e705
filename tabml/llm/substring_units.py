"""Repeated passages, by hashing lines and the sentences in them.

A text is cut into units at line ends and, within lines, after sentence ends;
so a passage pasted into the middle of a line still shares its inner units. A
unit is normalised (compatibility form, lower case, runs of anything but
letters and digits to one space) and named by a 128-bit digest. Sentences under
``min_words`` words are too common to tell anything and stay; in scripts without
spaces characters are counted. With ``whole_lines`` every line that has a letter or
digit is a unit too, however short, besides the sentences in it.

Digests are grouped over all texts with a partial minimum and count before the
shuffle. The occurrence of the lowest rank (id, hash, offset) of each repeated
digest stays, all others go; what is kept is known by its original offsets.
"""

from __future__ import annotations

import re
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import stored

#: A unit: up to a line end, a sentence end that space follows, or one of a script that puts no space there.
_UNIT = re.compile(r"[^\s](?:[^\n\r.!?。！？｡।॥۔؟።។။]+|[.!?](?!\s))*(?:[.!?]+(?=\s|$)|[。！？｡।॥۔؟።។။]+[」』）”’]*)?")
_OTHER = re.compile(r"[\W_]+")
#: Characters of scripts without spaces, and how many count as a word: kana and Han; Thai, Lao, Tibetan, Burmese, Khmer.
_UNSPACED = ((re.compile(r"[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]"), 2),
             (re.compile(r"[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff]"), 4))


@cache
def _other() -> re.Pattern:
    """``_OTHER``, but vowel signs and the like are part of words: without them different words would be equal."""
    import unicodedata

    marks = (c for c in map(chr, (*range(0x483, 0x180B), *range(0x1810, 0x20D0), *range(0xA66F, 0xFE00), *range(0x10000, 0x1F000))) if unicodedata.category(c) in ("Mn", "Mc"))
    return re.compile(rf"(?:[^\w{''.join(marks)}]|_)+")


def words(norm: str) -> float:
    """Words of a normalised unit."""
    n = norm.count(" ") + 1
    return n if norm.isascii() else max(n, sum(len(script.findall(norm)) / size for script, size in _UNSPACED))


def units(text: str, min_words: int, whole_lines: bool = False):
    """``(start, end, normalised)`` for the units of a text with at least ``min_words`` words, and with
    ``whole_lines`` for all its lines; a line of a single unit comes once."""
    import unicodedata

    line: list[tuple[int, int, str]] = []

    def ended():
        if len(line) == 1:
            yield line[0]
        elif line:
            yield line[0][0], line[-1][1], " ".join(norm for _, _, norm in line)
            yield from (u for u in line if words(u[2]) >= min_words)

    for m in _UNIT.finditer(text):
        start, end = m.span()
        if whole_lines:
            if line and ("\n" in (gap := text[line[-1][1]:start]) or "\r" in gap):
                yield from ended()
                line.clear()
        unit = m.group()
        if not unit.isascii():
            norm = _other().sub(" ", unicodedata.normalize("NFKC", unit).lower()).strip()
        elif whole_lines or len(unit) >= 2 * min_words - 1:
            norm = _OTHER.sub(" ", unit.lower()).strip()
        else:
            continue
        if not whole_lines:
            if norm and words(norm) >= min_words:
                yield start, end, norm
        elif norm:
            line.append((start, end, norm))
        elif line:  # marks only: they go with the unit before
            line[-1] = (line[-1][0], end, line[-1][2])
    yield from ended()


def unit_digests(docs: DataFrame, min_words: int, whole_lines: bool = False) -> DataFrame:
    """``(doc_id, row_hash, start, end, d1, d2)`` for all units of ``docs`` (doc_id, row_hash, text)."""
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, k) for n, k in (
        ("row_hash", T.LongType()), ("start", T.IntegerType()), ("end", T.IntegerType()),
        ("d1", T.LongType()), ("d2", T.LongType())))])

    def run(batches):
        import numpy as np
        from xxhash import xxh3_128_digest

        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                row, start, end, digest = [], [], [], []
                for i, text in enumerate(part.column(2).to_pylist()):
                    for a, b, norm in units(text or "", min_words, whole_lines):
                        row.append(i)
                        start.append(a)
                        end.append(b)
                        digest.append(xxh3_128_digest(norm.encode()))
                own = pa.array(row, pa.int32())
                d = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(own), part.column(1).take(own), pa.array(start, pa.int32()), pa.array(end, pa.int32()),
                     pa.array(d[:, 0]), pa.array(d[:, 1])], names=schema.fieldNames())

    return docs.mapInArrow(run, schema)


def repeated_units(docs: DataFrame, min_words: int, whole_lines: bool = False) -> DataFrame:
    """``(doc_id, row_hash, start, end)`` of all units but the first of each repeated digest; units of a
    row that is repeated as a whole come once, as later occurrences unless they are the first."""
    found = stored(unit_digests(docs, min_words, whole_lines), "unit-digests")  # read twice
    digests = (found.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "row_hash", "start")).alias("first"))
               .where("n > 1"))
    later = (F.col("row_hash") != F.col("first.row_hash")) | (F.col("start") != F.col("first.start")) | ~F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    return found.join(stored(digests, "repeated-units"), ["d1", "d2"]).where(later).select("doc_id", "row_hash", "start", "end")


def outermost(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, without those inside another: sentences of a line that goes as a whole."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans, key=lambda x: (x[0], -x[1])):
        if not out or b > out[-1][1]:
            out.append((a, b))
    return out


def cut(text: str, removed: list) -> tuple[str, list[tuple[int, int]]]:
    """The text without the removed spans (in order), and the kept spans; a span takes the white space after it along."""
    kept, at, out = [], 0, []
    for a, b in removed:
        if a > at:
            kept.append((at, a))
        while b < len(text) and text[b].isspace():
            b += 1
        at = max(at, b)
    if at < len(text):
        kept.append((at, len(text)))
    for a, b in kept:
        out.append(text[a:b])
    return "".join(out), kept


def drop_repeats(docs: DataFrame, min_words: int = 5, id_col: str = "doc_id", text_col: str = "text",
                 carry: list[str] | None = None, whole_lines: bool = False) -> DataFrame:
    """Every row of ``docs`` without its repeated units: sentences of ``min_words`` words or more, and with
    ``whole_lines`` lines of any length.

    Columns: ``doc_id``, the columns of ``carry``, ``text`` (what is kept), ``kept`` and
    ``removed`` (arrays of struct<start, end>: code point offsets in the original text).
    A unit repeats if another of the same digest has a lower rank: smaller id (null
    first), then hash of id and text, then offset. A null text stays null and has no
    units. Rows equal in id and text are one document here: they come out alike, each
    without what earlier documents hold. An empty table gives no rows.
    """
    carry = carry or []
    plain = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(id_col, text_col).alias("row_hash"),
                        F.col(text_col).alias("text"), *[F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)])
    spans = (repeated_units(plain.select("doc_id", "row_hash", "text"), min_words, whole_lines)
             .groupBy("row_hash", F.col("doc_id").alias("id")).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("removed")))
    joined = plain.join(spans, (plain.row_hash == spans.row_hash) & plain.doc_id.eqNullSafe(spans.id), "left")
    rows = joined.select("doc_id", "text", F.coalesce("removed", F.expr("cast(array() as array<struct<start:int,end:int>>)")).alias("removed"),
                         *[f"carry_{i}" for i in range(len(carry))])
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("text", T.StringType()), T.StructField("removed", span),
                           *[rows.schema[f"carry_{i}"] for i in range(len(carry))], T.StructField("kept", span)])

    def run(batches):
        pair = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in (b.slice(low, 500) for b in batches for low in range(0, b.num_rows, 500)):
            texts, kept, gone = [], [], []
            for text, removed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                inside = outermost([(r["start"], r["end"]) for r in removed])
                gone.append([{"start": a, "end": b} for a, b in inside])
                if text is None:
                    texts.append(None)
                    kept.append([])
                    continue
                new, spans = cut(text, inside)
                texts.append(new)
                kept.append([{"start": a, "end": b} for a, b in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(gone, pair), *batch.columns[3:], pa.array(kept, pair)],
                                             names=schema.fieldNames())

    return rows.mapInArrow(run, schema).select(
        "doc_id", *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)], "text", "kept", "removed")
