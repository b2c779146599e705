"""Repeated byte strings, by refining buckets of text positions.

A string of ``length`` bytes starts a *window* at each position. All windows
are to be found whose string starts at another position too.

1. Every position's first bucket is that of its q-gram of GRAM bytes. Bucket
   identifiers come from doubling: the identifier of 2h bytes at p combines
   those of h bytes at p and at the later offset p+h, and each level reuses
   the one before. A window is filed under the q-gram with the smallest
   identifier inside it, which equal windows have at equal places; neighbouring
   windows under the same q-gram are one *run*, about 170 of them. Runs alone in
   their bucket are done: no window of theirs repeats.
2. Runs whose whole strings are equal repeat entirely. Of each other string in
   a bucket that holds several, one row goes on, with its bytes.
3. A bucket of more than ``BUCKET`` rows is refined: its windows reach at least
   half of the missing bytes to one side of their q-gram, and are filed anew by
   the identifier of the string that is longer by so much. The step is applied
   to its own result until buckets are small or the string is a whole window.
4. In small buckets, windows with equal identifiers of ``length`` bytes repeat.

Identifiers have 64 bits. Whole buckets meet in one task only when small; the
counts that decide this are combined before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import stored

GRAM = 64
#: Bytes of text that are worked on at once.
SLICE = 1 << 20
#: Rows of a bucket that meet in one task.
BUCKET = 4096
_PLACE = np.uint64((1 << 24) - 1)


def _odd(n: int) -> np.ndarray:
    return np.random.default_rng(7).integers(1 << 62, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


_LETTER, _STEP = _odd(256), _odd(64)


def _join(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    """Identifiers of longer strings from those of two parts."""
    out = a * _STEP[2 * level]
    out += b
    out ^= out >> np.uint64(31)
    out *= _STEP[2 * level + 1]
    out ^= out >> np.uint64(29)
    return out


def identifiers(data: np.ndarray, length: int) -> np.ndarray:
    """Identifier of the ``length`` bytes at each place of ``data`` that has so many."""
    now, size, level = _LETTER[data], 1, 0
    while size < length:
        step = min(size, length - size)
        now = _join(now[:len(now) - step], now[step:], level)
        size, level = size + step, level + 1
    return now


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    size = 1
    while size < width:
        step = min(size, width - size)
        values = np.minimum(values[:len(values) - step], values[step:])
        size += step
    return values


def runs_of(data: np.ndarray, ends: np.ndarray, length: int):
    """Runs ``(first, last window, anchor)`` in the texts that end at ``ends`` in ``data``, as arrays."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3
    ids = identifiers(data, GRAM)
    marked = ids & ~_PLACE | np.arange(len(ids), dtype=np.uint64)
    anchor = (_least(marked, length - GRAM + 1) & _PLACE).astype(np.int64)
    good = np.ones(len(anchor), bool)
    for end in ends.tolist():
        good[max(0, end - length + 1):end] = False
    change = np.empty(len(anchor), bool)
    change[0] = True
    np.not_equal(anchor[1:], anchor[:-1], out=change[1:])
    change[1:] |= good[1:] != good[:-1]
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(anchor)) - 1
    use = good[first]
    return first[use], last[use], anchor[first[use]]


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values and offsets of a column of binaries or strings without nulls."""
    column = column.cast(pa.large_binary())
    _, offsets, values = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(values, np.uint8) if values else np.zeros(0, np.uint8), offsets


def _runs(docs: DataFrame, length: int) -> DataFrame:
    """``(doc_id, row_hash, first, last, gram, whole)`` for all runs of all texts."""
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, k) for n, k in (
        ("row_hash", T.LongType()), ("first", T.IntegerType()), ("last", T.IntegerType()),
        ("gram", T.LongType()), ("whole", T.LongType())))])

    def run(batches):
        from xxhash import xxh3_64_intdigest

        for batch in batches:
            values, offsets = _bytes(batch.column(2).fill_null(""))
            # parts of texts, with an overlap, so that no slice is larger than twice SLICE
            parts = [(i, a, min(a + SLICE + length - 1, int(offsets[i + 1])))
                     for i in np.flatnonzero(np.diff(offsets) >= length).tolist()
                     for a in range(int(offsets[i]), int(offsets[i + 1]) - length + 1, SLICE)]
            at = 0
            while at < len(parts):
                to, size = at, 0
                while to < len(parts) and (to == at or size + parts[to][2] - parts[to][1] <= SLICE):
                    size += parts[to][2] - parts[to][1]
                    to += 1
                row = np.array([p[0] for p in parts[at:to]])
                begin = np.array([p[1] for p in parts[at:to]])
                data = np.concatenate([values[a:b] for _, a, b in parts[at:to]])
                ends = np.cumsum([b - a for _, a, b in parts[at:to]])
                at = to
                first, last, anchor = runs_of(data, ends, length)
                if not len(first):
                    continue
                gram = _ids_at(data, anchor)
                raw = data.tobytes()
                whole = np.fromiter((xxh3_64_intdigest(raw[a:b]) for a, b in zip(first.tolist(), (last + length).tolist())),
                                    np.uint64, len(first))
                part = np.searchsorted(ends, first, "right")
                shift = begin[part] - (ends[part] - np.diff(ends, prepend=0)[part]) - offsets[row[part]]
                own = pa.array(row[part])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(own), batch.column(1).take(own),
                     pa.array((first + shift).astype(np.int32)), pa.array((last + shift).astype(np.int32)),
                     pa.array(gram.view(np.int64)), pa.array(whole.view(np.int64))], names=schema.fieldNames())

    return docs.mapInArrow(run, schema)


def _ids_at(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    return identifiers(data[places[:, None] + np.arange(GRAM)].T, GRAM)[0]


def _refined(rows: DataFrame, length: int) -> DataFrame:
    """Files the windows of each row under longer strings; at most two rows come of one."""

    def run(batches):
        from xxhash import xxh3_64_intdigest

        for batch in (b.slice(low, 500) for b in batches for low in range(0, b.num_rows, 500)):
            out = []
            for r in batch.to_pylist():
                windows, size, at, text = r["last"] - r["first"] + 1, r["size"], r["place"], r["bytes"]
                room = length - size
                more = -(-room // 2)
                # windows that reach ``more`` bytes beyond the string to its right, the others to its left
                border = min(max(at - (room - more), 0), windows)
                for a, b, x in ((border, windows, at), (0, border, at - more)):
                    if a < b:
                        key = xxh3_64_intdigest(text[x:x + size + more], size + more)
                        out.append({**r, "key": key - (1 << 64) if key >> 63 else key, "first": r["first"] + a,
                                    "last": r["first"] + b - 1, "place": x - a, "size": size + more,
                                    "bytes": text[a:b + length - 1]})
            yield pa.RecordBatch.from_pylist(out, schema=batch.schema)

    return rows.mapInArrow(run, rows.schema)


def _found(rows: DataFrame, length: int) -> DataFrame:
    """Spans ``(doc_id, row_hash, first, end)`` of repeated windows; partitions hold whole small buckets, in order of key."""
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in ("row_hash", "first", "end"))])

    def search(table: pa.Table):
        values, offsets = _bytes(table["bytes"].combine_chunks())
        data = values[offsets[0]:offsets[-1]]
        ends = offsets[1:] - offsets[0]
        ids = identifiers(data, length)
        good = np.ones(len(ids), bool)
        for end in ends.tolist():
            good[max(0, end - length + 1):end] = False
        window = np.flatnonzero(good)
        row = np.searchsorted(ends, window, "right")
        copies = table["copies"].to_numpy()
        _, which = np.unique(ids[window], return_inverse=True)
        times = np.bincount(which, copies[row])[which]
        keep = (times > 1) & (copies[row] == 1)
        window, row = window[keep], row[keep]
        if not len(window):
            return
        cut = np.append(True, (np.diff(window) != 1) | (np.diff(row) != 0))
        a = np.flatnonzero(cut)
        b = np.append(a[1:], len(window)) - 1
        own = pa.array(row[a])
        shift = table["first"].to_numpy()[row[a]] - (ends[row[a]] - np.diff(ends, prepend=0)[row[a]])
        yield pa.RecordBatch.from_arrays(
            [table["doc_id"].take(own).combine_chunks(), table["row_hash"].take(own).combine_chunks(),
             pa.array(window[a] + shift), pa.array(window[b] + shift + length)], names=schema.fieldNames())

    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            keys = batch.column(0).to_numpy()
            held.append(batch)
            size += batch.nbytes
            if size < SLICE:
                continue
            table = pa.Table.from_batches(held)
            keys = table["key"].to_numpy()
            open_at = int(np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))[-1])  # the last bucket may go on
            if open_at:
                at = 0
                while at < open_at:  # whole buckets of about SLICE bytes
                    to = min(open_at, at + 2048)
                    while to < open_at and keys[to] == keys[to - 1]:
                        to += 1
                    yield from search(table.slice(at, to - at))
                    at = to
                held = table.slice(open_at).to_batches()
                size = sum(b.nbytes for b in held)
        if held:
            yield from search(pa.Table.from_batches(held))

    return rows.mapInArrow(run, schema)


def repeated_spans(docs: DataFrame, length: int = 400) -> DataFrame:
    """``(doc_id, row_hash, first, end)``: byte spans of ``docs`` (doc_id, row_hash, text) that repeated windows
    cover; they may overlap."""
    runs = stored(_runs(docs, length), "runs")
    # a table of its own: else its partitioning by gram would bind the join to one task for a hot gram
    shared = stored(runs.groupBy("gram").count().where("count > 1").select("gram"), "shared-grams")
    runs = stored(runs.join(shared, "gram", "left_semi"), "shared-runs")
    kinds = stored(runs.groupBy("gram", "whole").agg(
        F.count("*").alias("copies"), F.min(F.struct("doc_id", "row_hash", "first", "last")).alias("one")), "run-kinds")
    spans = (runs.join(kinds.where("copies > 1").select("gram", "whole"), ["gram", "whole"], "left_semi")
             .select("doc_id", "row_hash", F.col("first").cast("long").alias("first"),
                     (F.col("last") + length).cast("long").alias("end")))
    several = stored(kinds.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1").select("gram"), "mixed-grams")
    mixed = kinds.join(several, "gram", "left_semi").select("gram", "copies", "one.*")
    # a repeated row's runs have copies, so the rows of one copy, which are judged below, come once
    texts = docs.select("row_hash", F.col("doc_id").alias("id"), F.col("text").cast("binary").alias("text"))
    rows = (mixed.join(texts, (mixed.row_hash == texts.row_hash) & mixed.doc_id.eqNullSafe(texts.id))
            .select(F.col("gram").alias("key"), "doc_id", mixed.row_hash, "first", "last", "copies",
                    F.expr(f"substring(text, first + 1, last - first + {length})").alias("bytes")))
    rows = stored(rows, "mixed-runs")
    rows = rows.select("key", "doc_id", "row_hash", "first", "last", "copies",
                       F.lit(0).alias("place"), F.lit(0).alias("size"), "bytes")
    rows = _placed(rows, length)
    size = GRAM
    while True:
        counts = rows.groupBy("key").agg(F.count("*").alias("n"), F.sum("copies").alias("all")).where("all > 1")
        counted = rows.join(counts, "key")
        small = (counted.where(F.col("n") <= BUCKET).select(rows.columns)
                 .repartition("key").sortWithinPartitions("key"))
        spans = spans.union(stored(_found(small, length), "spans"))
        large = stored(counted.where(F.col("n") > BUCKET).select(rows.columns), "large-buckets")
        if large.isEmpty():
            return spans
        if size == length:  # equal keys are equal windows
            return spans.union(large.where("copies = 1").select(
                "doc_id", "row_hash", F.col("first").cast("long").alias("first"), (F.col("last") + length).cast("long").alias("end")))
        size += -(-(length - size) // 2)
        rows = stored(_refined(large, length), "refined")


def _placed(rows: DataFrame, length: int) -> DataFrame:
    """Fills in where the q-gram lies in a row's bytes: the smallest marked identifier of its first window."""

    def run(batches):
        for batch in batches:
            places = []
            for data in batch.column(batch.schema.get_field_index("bytes")).cast(pa.binary()).to_pylist():
                ids = identifiers(np.frombuffer(data, np.uint8)[:length], GRAM) & ~_PLACE
                places.append(int(np.argmin(ids)))
            cols = {n: batch.column(n) for n in batch.schema.names}
            cols["place"] = pa.array(places, pa.int32())
            cols["size"] = pa.array([GRAM] * len(places), pa.int32())
            yield pa.RecordBatch.from_arrays([cols[n] for n in batch.schema.names], names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, removed array<struct<first, end>>, kept binary)`` for every row.

    Removed are all bytes covered by a string of ``length`` UTF-8 bytes that starts
    anywhere else too, in the same text or another; matches end at a text's end.
    ``removed`` has the maximal removed spans in order. A null text is an empty one.
    Null ids and repeated rows are rows of their own (copies of a long enough text
    lose all of it); other columns are not read.
    """
    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    plain = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(id_col, text_col).alias("row_hash"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spans = (repeated_spans(plain, length).groupBy("row_hash", F.col("doc_id").alias("id"))
             .agg(F.collect_set(F.struct("first", "end")).alias("spans")))
    joined = plain.join(spans, (plain.row_hash == spans.row_hash) & plain.doc_id.eqNullSafe(spans.id), "left")
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches):
        span = pa.struct([("first", pa.int64()), ("end", pa.int64())])
        for batch in (b.slice(low, 500) for b in batches for low in range(0, b.num_rows, 500)):
            n_bytes, removed, kept = [], [], []
            for text, spans in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                merged: list[dict] = []
                for s in sorted(spans or (), key=lambda s: s["first"]):
                    if merged and s["first"] <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], s["end"])
                    else:
                        merged.append(dict(s))
                at, parts = 0, []
                for s in merged:
                    parts.append(text[at:s["first"]])
                    at = s["end"]
                parts.append(text[at:])
                n_bytes.append(len(text))
                removed.append(merged)
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.list_(span)),
                 pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "removed", "kept"])

    return joined.select("doc_id", "text", "spans").mapInArrow(
        cut, f"doc_id {kind}, n_bytes long, removed array<struct<first:long,end:long>>, kept binary")
