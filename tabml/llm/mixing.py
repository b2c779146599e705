"""Mixing sources to target weights, in fixed-length blocks of words.

The words of each source, its documents in a seeded order, form one stream that
is cut into blocks of ``block`` words. The output is a number of shards of
``shard_slots`` slots; the source counts of a shard are a multinomial draw from
what the sources have still to give, so that the counts over all shards meet
each source's quota. The slots of a source are numbered through the shards, and
slot j takes block P(j mod blocks) where P is the source's pseudorandom
permutation for pass j div blocks. Slots and pieces of documents then meet in
one join on (source, block), of which every key has few rows on either side.

Only one row per source passes the driver. The shards' counts are drawn in tasks: the slots
are halved again and again, and each half's counts follow from a seed of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .store import stored

#: Words, as the library counts them.
WORD = r"[^\x20\x09-\x0D]+"
#: Documents in one ordered run of a source's stream, about.
RUN_DOCS = 2_000
#: Sources (rows of about 100 bytes) that are broadcast; more are joined by a shuffle, each in SALTS copies.
BROADCAST_SOURCES, SALTS = 100_000, 32
#: Shards whose counts one task draws in order: at least so many, and no more groups than GROUPS.
GROUP_SHARDS, GROUPS = 16, 4096


@dataclass
class Mix:
    """``documents``: a row per input row (row_hash, dup, doc_id, source, size, source_size, target, taken).

    ``pieces``: a row per slot and document in its block (shard, position, source,
    pass, block, at, row_hash, dup, doc_id, start, n_words): words ``start`` up to
    ``start + n_words`` of the document, from word ``at`` of the block on.
    """

    documents: DataFrame
    pieces: DataFrame


def targets(sizes: np.ndarray, weights: np.ndarray, limit: float) -> np.ndarray:
    """Share all sizes by weight; none above ``limit`` times its own, the excess reshared by weight."""
    out, total = np.zeros(len(sizes)), float(sizes.sum())
    free = sizes > 0
    while free.any():
        share = (total - out[~free].sum()) * weights / weights[free].sum()
        over = free & (share > limit * sizes)
        if not over.any():
            out[free] = share[free]
            break
        out[over] = limit * sizes[over]
        free &= ~over
    return out


def draw(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """A multinomial draw of ``n`` from sources in proportion to ``left``, none above what is left."""
    out = np.zeros(len(left), np.int64)
    while n:
        rest = left - out
        more = np.minimum(rng.multinomial(n, rest / rest.sum()), rest)
        out += more
        n -= int(more.sum())
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public splitmix64 constants)."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def permuted(index: np.ndarray, n: int, key: np.ndarray) -> np.ndarray:
    """Places of ``index`` under pseudorandom permutations of 0 .. n-1, one for each key: a
    four-round Feistel network over the next even power of two, walked until it falls below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        a, b = out[todo] >> np.uint64(half), out[todo] & low
        for r in range(4):
            a, b = b, a ^ (_mixed(b + key[todo] + np.uint64(r * 0x9E3779B97F4A7C15 & 2 ** 64 - 1)) & low)
        out[todo] = a << np.uint64(half) | b
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def share(quota: np.ndarray, group: int, groups: int, group_slots: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each source in one group of shards, and in all groups before it.

    The groups are halved until one is left; the lower half's counts are a multinomial draw from
    the whole's, seeded by the halves' bounds, so that every task finds the same without being told.
    """
    left, first, low, high, total = quota, np.zeros_like(quota), 0, groups, int(quota.sum())
    while high - low > 1:
        mid = (low + high) // 2
        below = draw(np.random.default_rng([seed, 1, low, high]), left, min(mid * group_slots, total) - low * group_slots)
        if group < mid:
            left, high = below, mid
        else:
            left, first, low = left - below, first + below, mid
    return left, first


def _slots(spark, blocks: np.ndarray, quota: np.ndarray, shard_slots: int, seed: int) -> DataFrame:
    """``(shard, position, ix, pass, block)`` for all slots."""
    total = int(quota.sum())
    group = max(GROUP_SHARDS, -(-total // (shard_slots * GROUPS)))
    groups = -(-total // (shard_slots * group))
    # two numbers for each source
    shared = spark.sparkContext.broadcast((blocks, quota))

    def run(frames):
        blocks, quota = shared.value
        keys = _mixed(np.arange(len(blocks), dtype=np.uint64) + np.uint64(seed << 32))
        for frame in frames:
            for which in frame["id"]:
                left, first = share(quota, int(which), groups, shard_slots * group, seed)
                shard = int(which) * group
                while left.any():
                    rng = np.random.default_rng([seed, 2, shard])
                    n = draw(rng, left, min(shard_slots, int(left.sum())))
                    place = rng.permutation(int(n.sum()))
                    ix = np.repeat(np.arange(len(n)), n)
                    turn, block = np.zeros(len(ix), np.int64), np.zeros(len(ix), np.int64)
                    to = np.cumsum(n)
                    for s in np.flatnonzero(n):
                        j = first[s] + np.arange(n[s])
                        mine = slice(to[s] - n[s], to[s])
                        turn[mine] = j // blocks[s]
                        block[mine] = permuted(j % blocks[s], int(blocks[s]), _mixed(keys[s] + turn[mine].astype(np.uint64)))
                    yield pd.DataFrame({"shard": shard, "position": place, "ix": ix, "pass": turn, "block": block})
                    left, first, shard = left - n, first + n, shard + 1

    return (spark.range(0, groups, 1, max(1, groups))
            .mapInPandas(run, "shard long, position long, ix int, pass long, block long"))


def mix(docs: DataFrame, weights: tuple = (5, 2, 1), limit: float = 3.0, block: int = 128,
        shard_slots: int = 8192, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> Mix:
    """Mix all documents so that sources come near their target shares of all words.

    Sources in code point order, the null source last, weigh ``weights`` in turn. A
    null or empty text has no words: size and taken 0. Null ids and repeated rows
    are rows of their own. A source without words gets the target 0. No document is
    taken more than ``limit`` (rounded down) times. Other columns are not read; an
    empty table gives empty results.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    sized = plain.select(
        F.xxhash64("doc_id", "text").alias("row_hash"), "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    sized = stored(sized, "sizes").withColumn("dup", F.row_number().over(W.partitionBy("row_hash").orderBy("doc_id")))

    found = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = np.array([r["size"] for r in found], np.int64)
    goal = targets(sizes, np.resize(np.array(weights, float), len(sizes)), limit)
    blocks = -(-sizes // block)
    quota = np.minimum(np.rint(goal * blocks / np.maximum(sizes, 1)), np.floor(limit) * blocks).astype(np.int64)
    sources = spark.createDataFrame(
        [(i, r.source, int(s), float(g), max(1, r["n"] // RUN_DOCS))
         for i, (r, s, g) in enumerate(zip(found, sizes, goal))],
        "ix int, source string, source_size long, target double, runs long")

    # a source's stream: runs by hash, in each run by hash; the runs' starts are a prefix sum over few rows
    if len(found) <= BROADCAST_SOURCES:
        known = sized.join(F.broadcast(sources), sized.source.eqNullSafe(sources.source)).drop(sources.source)
    else:  # a source may hold a third of all rows
        salted = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        same = sized.source.eqNullSafe(salted.source) & (F.pmod(sized.row_hash, F.lit(SALTS)) == salted.salt)
        known = sized.join(salted, same).drop(salted.source, salted.salt)
    placed = (known
              .withColumn("key", F.xxhash64(F.lit(seed), "row_hash"))
              .withColumn("run", F.expr("pmod(shiftright(key, 24), runs)")))
    starts = (placed.groupBy("ix", "run").agg(F.sum("size").alias("n"))
              .withColumn("first", F.sum("n").over(W.partitionBy("ix").orderBy("run").rowsBetween(W.unboundedPreceding, -1)))
              .select("ix", "run", F.coalesce("first", F.lit(0)).alias("first")))
    before = W.partitionBy("ix", "run").orderBy("key", "row_hash", "dup").rowsBetween(W.unboundedPreceding, -1)
    placed = (placed.join(starts, ["ix", "run"])
              .withColumn("begin", F.col("first") + F.coalesce(F.sum("size").over(before), F.lit(0)))
              .select("row_hash", "dup", "doc_id", "source", "size", "source_size", "target", "ix", "begin"))
    placed = stored(placed, "placed")

    spans = (placed.where("size > 0")
             .withColumn("block", F.explode(F.expr(f"sequence(begin div {block}, (begin + size - 1) div {block})")))
             .withColumn("start", F.greatest(F.col("block") * block - F.col("begin"), F.lit(0)))
             .withColumn("n_words", F.least(F.col("size"), (F.col("block") + 1) * block - F.col("begin")) - F.col("start"))
             .withColumn("at", F.greatest(F.col("begin") - F.col("block") * block, F.lit(0)))
             .select("ix", "block", "source", "row_hash", "dup", "doc_id", "begin", "at", "start", "n_words"))
    # the few rows that the slots are drawn from mislead the planner's estimate of their size, so it is told not to broadcast them
    slots = _slots(spark, blocks, quota, shard_slots, seed).hint("merge")
    pieces = slots.join(spans, ["ix", "block"])
    taken = pieces.groupBy("ix", "begin").agg(F.sum("n_words").alias("taken"))
    rows = (placed.join(taken.withColumn("some", F.lit(1)), ["ix", "begin"], "left")
            .select("row_hash", "dup", "doc_id", "source", "size", "source_size", "target",
                    F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).cast("long").alias("taken")))
    return Mix(rows, pieces.select("shard", "position", "source", "pass", "block", "at", "row_hash", "dup", "doc_id", "start", "n_words"))


def _with_takes(docs: DataFrame, takes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(text, takes, rest)`` for the rows of ``docs`` that ``takes`` (key_hash, key_dup, takes) names."""
    rest = [c for c in docs.columns if c != text_col]
    plain = docs.select(F.xxhash64(id_col, text_col).alias("key"), F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                        F.struct(*rest).alias("rest"))
    plain = plain.withColumn("number", F.row_number().over(W.partitionBy("key").orderBy("id")))
    return (plain.join(takes, (plain.key == takes.key_hash) & (plain.number == takes.key_dup))
            .select("text", "takes", "rest"))


def mixed_texts(docs: DataFrame, mixed: Mix, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with what ``mixed`` takes of them for a text: a row for each pass over a document.

    Words that lie next to each other keep the white space between them; gaps, where a
    pass skips a block, become a space. Rows of which nothing is taken are gone.
    """
    takes = (mixed.pieces.groupBy("row_hash", "dup", "pass").agg(F.collect_list(F.struct("start", "n_words")).alias("spans"))
             .groupBy("row_hash", "dup").agg(F.collect_list(F.struct("pass", "spans")).alias("takes"))
             .withColumnsRenamed({"row_hash": "key_hash", "dup": "key_dup"}))
    joined = _with_takes(docs, takes, id_col, text_col)

    def cut(batches):
        import re

        import pyarrow as pa

        word = re.compile(WORD)
        for batch in (b.slice(low, 200) for b in batches for low in range(0, b.num_rows, 200)):
            own, texts = [], []
            for i, (text, passes) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                at = [m.span() for m in word.finditer(text)]
                for one in sorted(passes, key=lambda p: p["pass"]):
                    runs: list[list[int]] = []
                    for s in sorted(one["spans"], key=lambda s: s["start"]):
                        if runs and runs[-1][1] == s["start"]:
                            runs[-1][1] += s["n_words"]
                        else:
                            runs.append([s["start"], s["start"] + s["n_words"]])
                    own.append(i)
                    texts.append(" ".join(text[at[a][0]:at[b - 1][1]] for a, b in runs))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column(2).take(pa.array(own, pa.int32()))], names=["text", "rest"])

    schema = joined.select("text", "rest").schema
    out = joined.mapInArrow(cut, schema)
    return out.select(*[F.col("text").alias(text_col) if c == text_col else F.col("rest").getField(c).alias(c) for c in docs.columns])


def shard_texts(docs: DataFrame, mixed: Mix, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mix as it stands in its shards: rows of ``docs`` with a part of their text each, partitioned by shard and in
    the order of its slots.

    A row is a run of a document's words that lie next to each other both in the document and in the
    shard, with the white space between them; words on either side of a block that is not there are rows
    of their own. Rows of which nothing is taken are gone. Columns are those of ``docs``.
    """
    takes = (mixed.pieces.groupBy(F.col("row_hash").alias("key_hash"), F.col("dup").alias("key_dup"))
             .agg(F.collect_list(F.struct("shard", "position", "at", "start", "n_words")).alias("takes")))
    joined = _with_takes(docs, takes, id_col, text_col)

    def cut(batches):
        import re

        import pyarrow as pa

        word = re.compile(WORD)
        for batch in (b.slice(low, 200) for b in batches for low in range(0, b.num_rows, 200)):
            own, rows = [], []
            for i, (text, pieces) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                spans = [m.span() for m in word.finditer(text)]
                runs: list[list[int]] = []  # shard, first slot, place in it, first word, end, last slot
                for p in sorted(pieces, key=lambda p: (p["shard"], p["position"])):
                    shard, slot, start = p["shard"], p["position"], p["start"]
                    if runs and (runs[-1][0], runs[-1][5] + 1, runs[-1][4]) == (shard, slot, start):
                        runs[-1][4:] = [start + p["n_words"], slot]
                    else:
                        runs.append([shard, slot, p["at"], start, start + p["n_words"], slot])
                own += [i] * len(runs)
                rows += [(shard, slot, at, text[spans[a][0]:spans[b - 1][1]]) for shard, slot, at, a, b, _ in runs]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(2).take(pa.array(own, pa.int32()))],
                                             names=["shard", "position", "at", "text", "rest"])

    schema = joined.select(*[F.lit(0).cast("long").alias(c) for c in ("shard", "position", "at")], "text", "rest").schema
    out = joined.mapInArrow(cut, schema).repartition("shard").sortWithinPartitions("shard", "position", "at")
    return out.select(*[F.col("text").alias(text_col) if c == text_col else F.col("rest").getField(c).alias(c) for c in docs.columns])
