"""SimHash near-duplicates, found with Burkhard-Keller trees.

Fingerprints within ``radius`` bits agree on at least one of ``radius + 1``
bands of any bit range. Distinct fingerprints are dealt to shards by the bands
they may share, two levels deep; the shards of at most MAX_TREE fingerprints
are each searched by one tree, whose children are keyed by the distance to
their parent and of which only the edges within the radius are followed. A
larger shard is split by the bands of its remaining bits, as often as needed:
once at most log2(MAX_TREE) bits remain free, it can't be larger. So the trees
travel with the shuffle, each of proven size, and the driver holds none.

A tree emits a spanning forest of its links rather than all pairs; the forest
has the same components. Exact copies share a fingerprint and enter once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .store import stored

BITS = 64
#: Fingerprints in one tree.
MAX_TREE = 1024
SEED = 42

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_PLACE = 256 * np.arange(8)


def simhash(text: bytes, shingle: int) -> int:
    """64-bit SimHash of the space-joined word shingles of a text, repeats included; 0 without words."""
    from xxhash import xxh64_digest

    words = text.lower().split()  # A-Z; words end at \x20 and \x09-\x0D
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = b"".join([xxh64_digest(g, SEED) for g in grams])
    places = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    seen = np.bincount((places + _PLACE).ravel(), minlength=2048).reshape(8, 256)
    bits = (seen @ _BYTE_BITS).ravel() * 2 > len(places)
    return int.from_bytes(np.packbits(bits).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``(doc_id, fp)`` and the columns of ``carry`` for every row; ``fp`` is the fingerprint's 64 bits as a long,
    0 for null or wordless texts."""
    carry = carry or []
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)])
    schema = T.StructType([plain.schema["doc_id"], T.StructField("fp", T.LongType()), *plain.schema.fields[2:]])

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            fp = [simhash(t.as_py() or b"", shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64()), *batch.columns[2:]], names=schema.fieldNames())
        pa.default_memory_pool().release_unused()  # the worker lives on

    return plain.mapInArrow(run, schema).select("doc_id", "fp", *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)])


class BkTree:
    """Children are keyed by their integer Hamming distance to the parent."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[int]:
        """Places of the values within the radius, following only edges that can lead to one."""
        found, todo = [], [0] if self.values else []
        values, children = self.values, self.children
        while todo:
            at = todo.pop()
            d = (values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            for edge, child in children[at].items():
                if -radius <= edge - d <= radius:
                    todo.append(child)
        return found

    def add(self, value: int) -> int:
        place = len(self.values)
        at = 0
        while place:
            d = (self.values[at] ^ value).bit_count()
            if d not in self.children[at]:
                self.children[at][d] = place
                break
            at = self.children[at][d]
        self.values.append(value)
        self.children.append({})
        return place


def forest(values: list[int], radius: int):
    """Links of a spanning forest of the given distinct values (unsigned)."""
    if len(values) == 2:
        if (values[0] ^ values[1]).bit_count() <= radius:
            yield values[1], values[0]
        return
    tree, root = BkTree(), []
    for value in values:
        near = tree.near(value, radius)
        place = tree.add(value)
        root.append(place)
        for other in near:
            r = other
            while root[r] != r:
                root[r] = root[root[r]]
                r = root[r]
            if r != place:
                root[r] = place
                yield value, tree.values[other]


def bands(mask: int, n: int) -> list[int]:
    """The masks that fix, besides ``mask``, one of ``n`` near-equal bands of the bits it leaves free."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    cut = [len(free) * i // n for i in range(n + 1)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(cut, cut[1:])]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> BITS - 1 else x


def _search(shards: DataFrame, radius: int) -> DataFrame:
    """Forest links of all shards; ``shards`` has whole shards in each partition, in order of (mask, part)."""

    def run(batches):
        left = None  # rows of the shard that goes on in the next batch
        out: list[tuple[int, int]] = []

        def tables():
            for batch in batches:
                yield [c.to_numpy() for c in batch.columns]
            yield None

        for cols in tables():
            last = cols is None
            if last:
                cols = left
            elif left is not None:
                cols = [np.concatenate(x) for x in zip(left, cols)]
            if cols is None or not len(cols[0]):
                continue
            mask, part, fp = cols
            cut = np.flatnonzero((mask[1:] != mask[:-1]) | (part[1:] != part[:-1])) + 1
            cut = [0, *cut.tolist(), *([len(fp)] if last else [])]
            unsigned = fp.view(np.uint64).tolist()
            for a, b in zip(cut, cut[1:]):
                if b - a > 1:
                    out.extend(forest(unsigned[a:b], radius))
            left = [c[cut[-1]:] for c in cols]
            if out:
                pairs = np.array(out, np.uint64).view(np.int64)
                out.clear()
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return shards.mapInArrow(run, "a long, b long")


def links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs within the radius; ``distinct`` has a column ``fp``."""
    spark = distinct.sparkSession
    masks = [m for first in bands(0, radius + 1) for m in bands(first, radius + 1)]
    fp = distinct.select("fp")
    found = None
    while True:
        keyed = (fp.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
                 if "mask" not in fp.columns else fp)
        keyed = keyed.withColumn("part", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = keyed.groupBy("mask", "part").count().where("count > 1")
        keyed = keyed.join(sizes, ["mask", "part"])
        shards = (keyed.where(F.col("count") <= MAX_TREE).select("mask", "part", "fp")
                  .repartition("mask", "part").sortWithinPartitions("mask", "part", "fp"))
        some = stored(_search(shards, radius).distinct(), "links")
        found = some if found is None else found.union(some)
        free = BITS - min(m.bit_count() for m in masks)
        if 1 << free <= MAX_TREE:
            return found
        large = stored(keyed.where(F.col("count") > MAX_TREE).select("mask", "fp"), "large")
        if large.isEmpty():
            return found
        split = spark.createDataFrame([(_signed(m), [_signed(x) for x in bands(m, radius + 1)]) for m in masks],
                                      "mask long, next array<long>")
        masks = sorted({x for m in masks for x in bands(m, radius + 1)})
        fp = (large.join(split, "mask").select("fp", F.explode("next").alias("mask")).distinct())


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3,
                    id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``(doc_id, fp, component, component_id)`` and the columns of ``carry`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most
    ``radius`` differing bits, the row's own included. Null and wordless texts
    have fingerprint zero and link like any other. Rows with a null id take part
    and never name a component, which has a null ``component_id`` if all its ids are null;
    ``component``, one of its fingerprints, tells components apart in any case. Repeated rows
    stay separate rows of one component; other columns are not read.
    """
    fps = stored(fingerprints(docs, shingle, id_col, text_col, carry), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    nodes = components(links(distinct, radius)).withColumnRenamed("node", "fp")
    known = distinct.join(nodes, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = known.groupBy("component").agg(F.min("least").alias("component_id"))
    names = stored(known.join(named, "component").select("fp", "component", "component_id"), "names")
    return fps.join(names, "fp").select("doc_id", "fp", "component", "component_id", *(carry or []))
