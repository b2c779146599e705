"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosine.

A vector, scaled to length one, falls in ``tables`` buckets; a bucket's name is
the label and ``hashes`` random Gaussian projections, shifted, cut to cells of
``width``. Unit vectors of cosine 0.98 lie 0.2 apart, so one projection agrees
with probability 0.840, ten with 0.176, and one of 24 tables with 0.990; closer
pairs are found more surely. Unrelated vectors (1.41 apart) share a bucket with
probability 2e-6 each table.

Equal vectors are one row with a count before any of this. A bucket of more
than ``cell`` rows is cut into blocks, each pair of which is a cell of its own,
so no task gets more than about twice ``cell`` rows at once. A cell computes the
cosines in double precision and returns counts and a spanning forest, not
pairs; a pair counts in the first table that holds both.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .groups import runs
from .mixing import _mixed
from .store import stored


def projections(dim: int, tables: int, hashes: int, width: float, seed: int):
    rng = np.random.default_rng([seed, dim, tables, hashes])
    return rng.standard_normal((dim, tables * hashes)) / width, rng.random(tables * hashes)


def forest(linked: np.ndarray):
    """Spanning forest, as (row, column) pairs, of the bipartite graph of a boolean matrix."""
    rows, cols = linked.any(axis=1), linked.any(axis=0)
    for start in np.flatnonzero(rows).tolist():
        if not rows[start]:
            continue
        rows[start] = False
        todo = [start]
        while todo:
            new_cols = []
            for r in todo:
                c = np.flatnonzero(linked[r] & cols)
                cols[c] = False
                new_cols.extend(c.tolist())
                yield from ((r, x) for x in c.tolist())
            todo = []
            for c in new_cols:
                r = np.flatnonzero(linked[:, c] & rows)
                rows[r] = False
                todo.extend(r.tolist())
                yield from ((x, c) for x in r.tolist())


def _compare(cell: pa.Table, threshold: float):
    """Link counts and forest links of one cell."""
    one = cell.slice(0, 1).to_pylist()[0]
    n, turn = cell.num_rows, one["turn"]
    x = cell["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
    keys = cell["keys"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
    rid, copies, block = (cell[c].to_numpy() for c in ("rid", "copies", "block"))
    left = np.flatnonzero(block == one["i"])
    right = left if one["i"] == one["j"] else np.flatnonzero(block == one["j"])
    if not len(left) or not len(right):
        return
    linked = x[left] @ x[right].T >= threshold
    for t in range(turn):
        linked &= keys[left, t][:, None] != keys[right, t][None, :]
    if left is right:
        np.fill_diagonal(linked, False)
    if not linked.any():
        return
    for side, ends, m in ((left, right, linked), (right, left, linked.T))[:1 if left is right else 2]:
        n_links = m @ copies[ends]
        for k in np.flatnonzero(n_links).tolist():
            yield rid[side[k]], None, n_links[k]
    for a, b in forest(linked):
        yield rid[left[a]], rid[right[b]], None


def near_vectors(vectors: DataFrame, threshold: float = 0.98, tables: int = 24, hashes: int = 10, width: float = 1.0,
                 cell: int = 1024, seed: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors``.

    Links join vectors of equal, non-null label and length with a cosine of at
    least ``threshold``. A null or zero vector, one with null or non-finite
    components, and one with a null label link with nothing. Equal rows link with
    each other and count as often as they occur. Rows with a null id take part;
    they name no component and are not kept. Other columns are not read.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    usable = F.expr("label is not null and vector is not null and size(vector) > 0"
                    " and not exists(vector, x -> x is null or isnan(x) or abs(x) = double('Infinity'))"
                    " and exists(vector, x -> x <> 0)")
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    rows = rows.withColumn("h", F.when(F.col("usable"), F.struct(
        F.xxhash64("label", "vector").alias("a"), F.xxhash64(F.lit(seed), "vector", "label").alias("b"))))
    rows = stored(rows, "vectors")
    distinct = (rows.where("usable").groupBy("h").agg(
        F.first("vector").alias("vector"), F.first("label").alias("label"), F.count("*").alias("copies"),
        F.min("vec_id").alias("least")).withColumn("rid", F.monotonically_increasing_id()))

    def sign(batches):
        for batch in batches:
            lists = batch.column(0)
            lengths = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False).copy()
            starts = np.cumsum(lengths) - lengths
            label = batch.column(1).to_numpy()
            keys = np.zeros((len(lengths), tables), np.uint64)
            for dim in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == dim)
                x = flat[starts[own][:, None] + np.arange(dim)]
                x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                flat[starts[own][:, None] + np.arange(dim)] = x
                p, shift = projections(dim, tables, hashes, width, seed)
                cells = np.floor(x @ p + shift).astype(np.int64).view(np.uint64).reshape(len(own), tables, hashes)
                key = np.broadcast_to((label[own].astype(np.uint64) * np.uint64(1 << 20) + np.uint64(dim))[:, None],
                                      (len(own), tables)) + np.arange(tables, dtype=np.uint64) * np.uint64(1 << 56)
                for k in range(hashes):
                    key = _mixed(key ^ cells[:, :, k])
                keys[own] = key
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(flat)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(lengths) + 1) * tables, pa.int32()),
                                          pa.array(keys.view(np.int64).ravel())),
                 *batch.columns[2:]], names=["vector", "keys", "h", "copies", "least", "rid"])

    signed = (distinct.select("vector", F.xxhash64("label").alias("label"), "h", "copies", "least", "rid")
              .mapInArrow(sign, "vector array<double>, keys array<long>, h struct<a:long,b:long>, copies long,"
                          f" least {rows.schema['vec_id'].dataType.simpleString()}, rid long"))
    signed = stored(signed, "signed")
    buckets = signed.select("rid", F.posexplode("keys").alias("turn", "key"))
    sizes = buckets.groupBy("turn", "key").count().where("count > 1")
    placed = (buckets.join(sizes, ["turn", "key"])
              .withColumn("blocks", F.ceil(F.col("count") / cell).cast("int"))
              .withColumn("block", F.expr("cast(pmod(xxhash64(rid, turn), blocks) as int)"))
              .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
              .select("turn", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                      "block", "rid"))
    order = ["turn", "key", "i", "j"]
    cells = (placed.join(signed.select("rid", "copies", "vector", "keys"), "rid")
             .select(*order, "block", "rid", "copies", "vector", "keys")
             .repartition(*order).sortWithinPartitions(*order))

    def compare(batches):
        out = []
        for group in runs(batches, len(order)):
            if group.num_rows > 1:
                out.extend(_compare(group, threshold))
            if len(out) > 50_000:
                yield _links(out)
                out = []
        yield _links(out)

    found = stored(cells.mapInArrow(compare, "a long, b long, n long"), "vector-links")
    nodes = components(found.where("b is not null").select("a", "b"))
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    known = (signed.select("rid", "h", "copies", "least")
             .join(nodes.withColumnRenamed("node", "rid"), "rid", "left")
             .join(counts.withColumnRenamed("a", "rid"), "rid", "left")
             .withColumn("component", F.coalesce("component", "rid")))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(least, "component").select(
        "h", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.join(known, "h", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _links(rows: list) -> pa.RecordBatch:
    cols = zip(*rows) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "n"])
