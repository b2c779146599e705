"""The training table that many fits share, and the parts of it that they see."""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.functions.exprs import md5_key
from tabml.functions.rank import hash_rank
from tabml.operators.split import fold_rank_array
from tabml.session import work_dir

#: Folds inside a part: of a stack's bases (level 1) and of Platt scaling (level 2).
INNER = 5
RANK, KEY = "train_rank", "train_key"


@dataclass(frozen=True)
class Part:
    """The rows outside fold ``held[level]`` of each level, and of these (level 0) the first ``limit`` in hash order."""

    held: tuple = (None, None, None)
    limit: int | None = None

    def without(self, level: int, fold: int) -> "Part":
        return Part(tuple(fold if i == level else h for i, h in enumerate(self.held)), self.limit)


#: The arrays of a block, by name.
PACKED = {"x": np.float64, "y": np.int8, "key": np.uint64, "folds": np.int8, "ranks": np.int64}


def packed(batches):
    """A row for each batch of rows: its arrays as bytes. Later scans copy these instead of converting each row."""
    for batch in batches:
        if batch.num_rows:
            rows = Rows(batch)
            made = {name: np.ascontiguousarray(getattr(rows, name)).astype(dtype, copy=False).tobytes() for name, dtype in PACKED.items()}
            yield pa.RecordBatch.from_pylist([{"n": rows.n, **made}], schema=BLOCK)


BLOCK = pa.schema([("n", pa.int32()), *((name, pa.binary()) for name in PACKED)])
BLOCK_SQL = ", ".join(["n int", *(f"{name} binary" for name in PACKED)])


#: Rows of one block of cells, at least, but for a task's last.
CELL_ROWS = 1 << 16
CELLS = {"bins": np.uint8, "cell": np.int32, "y": np.int8, "key": np.uint64, "folds": np.int8, "ranks": np.int64}
CELL_BLOCK = pa.schema([("n", pa.int32()), ("c", pa.int32()), *((name, pa.binary()) for name in CELLS)])
CELL_SQL = ", ".join(["n int", "c int", *(f"{name} binary" for name in CELLS)])


def binned(x: np.ndarray, edges: list) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(edges)]) if edges else np.zeros((len(x), 0), np.int64)


def row_type(k: int) -> np.dtype:
    """What a cell keeps of a row; ``k`` ranks."""
    return np.dtype([("y", np.int8), ("folds", np.int8, (3,)), ("key", np.uint64), ("ranks", np.int64, (k,))])


def rows_in(batch: pa.RecordBatch):
    """The batches of rows that an Arrow batch holds: itself, or each of its blocks."""
    if "n" not in batch.schema.names:
        if batch.num_rows:
            yield Rows(batch)
        return
    kind = Cells if "c" in batch.schema.names else Rows
    for i in range(batch.num_rows):
        yield kind(batch.slice(i, 1), True)


class Rows:
    """Rows of the table as arrays, from one Arrow batch or one block (of it the arrays that the block has)."""

    def __init__(self, batch: pa.RecordBatch, block: bool = False):
        if block:
            self.n = batch.column("n")[0].as_py()
            raw = {name: np.frombuffer(batch.column(name)[0].as_buffer(), dtype) for name, dtype in PACKED.items() if name in batch.schema.names}
            self.y = raw["y"].astype(np.float64)
            self.key = raw.get("key")
            self.x, self.folds, self.ranks = (raw[name].reshape(self.n, -1) if name in raw else None for name in ("x", "folds", "ranks"))
            self.extra = batch.column("extra")[0].as_buffer() if "extra" in batch.schema.names else None
            return

        def matrix(name, dtype):
            col = batch.column(name)
            return col.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(col), -1)

        self.n = batch.num_rows
        self.x = matrix("x", np.float64)
        self.y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.float64)
        self.key = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
        self.folds = matrix("folds", np.int64)
        self.ranks = matrix("ranks", np.int64)
        self.extra = batch.column("extra") if "extra" in batch.schema.names else None

    def once(self, name, make):
        """``make()`` once for these rows."""
        kept = self.__dict__.setdefault("_kept", {})
        if name not in kept:
            kept[name] = make()
        return kept[name]

    def last(self, name, make):
        """``make()``, or what it gave if it was asked for by this name last: where all of them would be too much to hold."""
        if self.__dict__.get("_last", (None,))[0] != name:
            self._last = name, make()
        return self._last[1]

    def take(self, at: np.ndarray) -> "Rows":
        """Some of the rows, ``at`` being their places here."""
        out = object.__new__(Rows)
        out.n, out.at, out.x, out.y, out.key = len(at), at, self.x[at], self.y[at], self.key[at]
        out.folds, out.ranks, out.extra = self.folds[at], self.ranks[at], None
        return out

    def binned(self, edges: list) -> np.ndarray:
        """The bins of the features, made once."""
        return self.once("bins", lambda: binned(self.x, edges))

    def bytes_of(self, dtype) -> np.ndarray:
        """The ``extra`` column, a row of ``dtype`` numbers each."""
        if isinstance(self.extra, pa.Buffer):
            return np.frombuffer(self.extra, dtype).reshape(self.n, -1)
        offsets = np.frombuffer(self.extra.buffers()[1], np.int32)[self.extra.offset:self.extra.offset + self.n + 1]
        raw = np.frombuffer(self.extra.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        return raw.view(dtype).reshape(self.n, -1)

    def member(self, part: Part) -> np.ndarray:
        out = np.ones(self.n, bool)
        for level, fold in enumerate(part.held):
            if fold is not None:
                out &= self.folds[:, level] != fold
        if part.limit is not None:
            out &= self.ranks[:, part.held[0]] <= part.limit
        return out

    def uniform(self, seed: int) -> np.ndarray:
        """A number in [0, 1) for each row, from its key and the seed alone."""
        mask = (1 << 64) - 1
        z = self.key + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & mask)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


class Cells(Rows):
    """Rows grouped by the bins of their features: ``bins`` has a row for each of the ``c`` cells, ``cell`` a cell for each row."""

    def __init__(self, batch: pa.RecordBatch, block: bool = True):
        self.n, self.c = batch.column("n")[0].as_py(), batch.column("c")[0].as_py()
        raw = {name: np.frombuffer(batch.column(name)[0].as_buffer(), dtype) for name, dtype in CELLS.items()}
        self.bins, self.cell = raw["bins"].reshape(self.c, -1).astype(np.int64), raw["cell"]
        self.y, self.key = raw["y"].astype(np.float64), raw["key"]
        self.folds, self.ranks = raw["folds"].reshape(3, self.n).T, raw["ranks"].reshape(-1, self.n).T
        self.extra = batch.column("extra")[0].as_buffer() if "extra" in batch.schema.names else None

    def bytes_of(self, dtype) -> np.ndarray:
        """As of rows, a row for each cell."""
        return np.frombuffer(self.extra, dtype).reshape(self.c, -1)

    def sums(self, weight: np.ndarray):
        """Each cell's weight, and that of its rows of class 1."""
        return np.bincount(self.cell, weight, self.c), np.bincount(self.cell, weight * self.y, self.c)


def celled(edges: list, k: int):
    """A task that gives each row's bins, and what a cell keeps of the row."""
    kind = row_type(k)

    def give(batches):
        for batch in batches:
            for rows in rows_in(batch):
                kept = np.zeros(rows.n, kind)
                kept["y"], kept["folds"], kept["key"], kept["ranks"] = rows.y, rows.folds, rows.key, rows.ranks.reshape(rows.n, k)
                yield pa.RecordBatch.from_arrays([fixed(binned(rows.x, edges).astype(np.uint8)), fixed(kept)], names=["bins", "kept"])

    return give


def fixed(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    rows = np.ascontiguousarray(rows)
    size = rows.nbytes // len(rows)
    offsets = np.arange(len(rows) + 1, dtype=np.int64) * size
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(rows.tobytes())])


def unfixed(column: pa.Array) -> bytes:
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return column.buffers()[2][int(offsets[0]):int(offsets[-1])].to_pybytes() if column.buffers()[2] is not None else b""


def packed_cells(d: int, k: int):
    """A task that packs rows, sorted by bins, into blocks of cells."""
    kind = row_type(k)

    def block(held):
        bins = np.frombuffer(b"".join(b for b, _ in held), np.uint8)
        kept = np.frombuffer(b"".join(r for _, r in held), kind)
        bins = bins.reshape(len(kept), d)
        first = np.ones(len(kept), bool)
        first[1:] = (bins[1:] != bins[:-1]).any(axis=1)
        made = {"bins": bins[first], "cell": first.cumsum() - 1, "y": kept["y"], "key": kept["key"], "folds": kept["folds"].T, "ranks": kept["ranks"].T}
        made = {name: np.ascontiguousarray(made[name], dtype).tobytes() for name, dtype in CELLS.items()}
        return pa.RecordBatch.from_pylist([{"n": len(kept), "c": int(first.sum()), **made}], schema=CELL_BLOCK)

    def pack(batches):
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append((unfixed(batch.column(0)), unfixed(batch.column(1))))
                n += batch.num_rows
            if n >= CELL_ROWS:
                yield block(held)
                held, n = [], 0
        if n:
            yield block(held)

    return pack


@dataclass
class Frame:
    """Rows ``(x, y, key, folds, ranks)``, and ``blocks`` of them (see ``packed``), persisted until ``release``, that fits scan.
    Fits of trees scan ``cells``, the rows of equal bins together: made when first read, held as long."""

    rows: DataFrame
    dim: int
    n: int
    k: int
    edges: list = field(default_factory=list)
    blocks: DataFrame | None = None
    ranked: int = 0     # ranks of a row
    made: dict = field(default_factory=dict)
    lock: object = field(default_factory=threading.Lock)

    @property
    def cells(self) -> DataFrame:
        """The rows dealt out by ranges of their bins, so that a cell lies in one task and the cells are no more with more
        tasks; a frequent one is cut inside, by its rows' keys, and lies in several. Sums of cells may be added in any parts."""
        with self.lock:
            if "cells" not in self.made:
                rows = self.blocks.mapInArrow(celled(self.edges, self.ranked), "bins binary, kept binary")
                rows = rows.repartitionByRange(max(1, self.blocks.rdd.getNumPartitions()), "bins", "kept").sortWithinPartitions("bins")
                self.made["cells"] = rows.mapInArrow(packed_cells(self.dim, self.ranked), CELL_SQL).persist(StorageLevel.MEMORY_AND_DISK)
            return self.made["cells"]

    def release(self) -> None:
        with self.lock:
            for table in (*self.made.values(), self.blocks):
                table.unpersist()
            self.made = {}

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.release()


def training_frame(train: DataFrame, k: int = 0, curve: bool = False, max_bins: int = 32,
                   features_col: str = "features", label_col: str = "label") -> Frame:
    """The frame of ``train`` (features vector, label 0/1, ``fold`` when ``k`` > 0, ``id`` and hash ``h`` if it has them).

    ``curve`` adds each row's rank in the training part of each fold: an array
    of ``k`` numbers, no copies. Inner folds deal the rows of a class in hash
    order, so they are stratified, also inside a fold, and copies of a row with
    ids of their own are spread. Rows without an id are hashed by content. A
    column ``train_rank``, the rank in hash order inside the class, saves that order, and
    ``train_key`` is the ids' 64-bit hash where the ids themselves were left out.
    Bin edges are quantiles of all rows of the table.
    """
    spark = train.sparkSession
    if KEY not in train.columns and "id" not in train.columns:
        train = train.withColumn("id", F.to_json(F.struct(vector_to_array(features_col).alias("x"), F.col(label_col).alias("y"))))
    ordered = RANK in train.columns and not curve
    if "h" not in train.columns and not ordered:
        train = train.withColumn("h", md5_key("id", seed=42))
    fold = F.col("fold").cast("int") if k else F.lit(-1)
    key = F.col(KEY) if KEY in train.columns else F.xxhash64("id")
    rows = train.select(key.alias("key"), *([] if ordered else ["h"]), vector_to_array(features_col).alias("x"), F.col(label_col).cast("int").alias("label"),
                        fold.alias("fold"), F.lit("train").alias("split"), *([RANK] if RANK in train.columns else [])).where("label is not null")
    if k:
        rows = rows.where("fold is not null")
    if RANK in train.columns:
        rows = rows.withColumnRenamed(RANK, "r")
    else:
        rows = hash_rank(rows, ["label"], "h", out="r")
    rows = fold_rank_array(rows, k, out="ranks") if curve else rows.withColumn("ranks", F.array().cast("array<bigint>"))
    step = max(k, 1)
    deal = [F.expr(f"cast(floor((r - 1) / {step * INNER ** i}) % {INNER} as int)") for i in range(2)]
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = (rows.select("x", F.col("label").alias("y"), "key", F.array("fold", *deal).alias("folds"), "ranks")
            .repartition(parts, "key").sortWithinPartitions("key", "x", "y"))
    blocks = rows.mapInArrow(packed, BLOCK_SQL).persist(StorageLevel.MEMORY_AND_DISK)
    first = blocks.select("n", F.length("x").alias("size")).first()
    d = first["size"] // (8 * first.n) if first else 0
    share = [i / max_bins for i in range(1, max_bins)]
    cuts = (blocks.mapInArrow(features, ", ".join(["n bigint", *(f"q{i} double" for i in range(d))]))
            .agg(F.count("*").alias("n"), *[F.percentile_approx(f"q{i}", share, 10_000).alias(f"q{i}") for i in range(d)]).first())
    edges = [np.unique(np.array(cuts[f"q{i}"], float)) for i in range(d)]
    return Frame(rows, d, cuts.n, k, edges, blocks, k if curve else 0)


def features(batches):
    """Blocks as rows of plain columns."""
    for batch in batches:
        for rows in rows_in(batch):
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(rows.n, np.int64)), *(pa.array(np.ascontiguousarray(c)) for c in rows.x.T)],
                                             names=["n", *(f"q{i}" for i in range(rows.x.shape[1]))])


def table_of(blocks: DataFrame, make, name: str, only=None) -> DataFrame:
    """``blocks`` (of them the columns ``only``) with the column ``extra`` = ``make(Rows)`` (a matrix, a row for each row
    or cell, kept as bytes), written to the shared folder."""
    kept = [c for c in only or blocks.columns if c != "extra"]

    def add(batches):
        for batch in batches:
            for i, rows in enumerate(rows_in(batch)):
                extra = pa.array([np.ascontiguousarray(make(rows)).tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, 1) for c in kept), extra], names=[*kept, "extra"])

    schema = ", ".join(f"{c} {blocks.schema[c].dataType.simpleString()}" for c in kept)
    path = f"{work_dir(blocks.sparkSession, 'fits')}/{name}-{uuid.uuid4().hex}"
    made = blocks.mapInArrow(add, f"{schema}, extra binary")
    made.write.parquet(path)
    return blocks.sparkSession.read.schema(made.schema).parquet(path)


class Adder:
    """Sums ``work(Rows)`` over the batches of a task."""

    def __init__(self, work):
        self.work, self.total = work, 0.0

    def see(self, rows: Rows) -> None:
        self.total = self.total + np.asarray(self.work(rows), float)

    def result(self):
        return self.total


def summed(rows: DataFrame, work, shape: tuple, task=Adder) -> np.ndarray:
    """The sum over all tasks of ``task(work).result()``, an array of ``shape``, after the task's batches were seen;
    where tasks are many, their results are added in fewer tasks first."""
    def added(batches):
        one = task(work)
        for batch in batches:
            for rows in rows_in(batch):
                one.see(rows)
        total = np.zeros(shape) + one.result()
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    def again(batches):
        total = np.zeros(shape)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                total += np.frombuffer(part, np.float64).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    parts, tasks = rows.mapInArrow(added, "part binary"), rows.rdd.getNumPartitions()
    if tasks > 64:
        parts = parts.repartition(int(tasks ** 0.5)).mapInArrow(again, "part binary")
    return np.sum([np.frombuffer(r.part, np.float64) for r in parts.collect()], axis=0).reshape(shape)
