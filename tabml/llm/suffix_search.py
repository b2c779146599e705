"""Benchmark passages in documents, by binary search in suffix arrays of the documents.

A task numbers the words of its documents by the benchmark's vocabulary (any
other word, and the end of a document, is 0) and sorts the suffixes that begin
with enough known words: first by three packed words, then by doubling the
depth among suffixes still tied, to the depth of a window. Each shard holds at
most ``SHARD`` positions, so its arrays are bounded; it reads on past its end
by that depth, so no window is cut. Every test suffix is looked up by binary
search, three words a step. The interval left at the window's depth holds all
its places; places that follow one another in both texts are one match, however
long, so deeper order would change nothing.

The benchmark is the query set. It is cut into stretches, which overlap by one
window less a word, and dealt to blocks of at most ``BLOCK_WORDS`` words. One
block at a time is broadcast, and one that is too large is dealt anew, so the
broadcast does not grow with the benchmark; the passes do.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored

WINDOW = 10
#: Words of one broadcast block (about 50 MB in a worker at most) and of one stretch of an item.
BLOCK_WORDS, STRETCH = 200_000, 2_000
#: Suffixes sorted at once; 21 bits hold a word's number, as a block has fewer words.
SHARD, BITS = 1 << 20, 21
#: Bytes of text cut into words at once.
PIECE = 1 << 22
#: Pairs of an occurrence and a place in an item held at once, for one document.
PAIRS = 1 << 20

# lower-case A-Z; 0-9, a-z and all bytes of non-ASCII characters are word bytes, the rest are blanks
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

MATCH = "struct<start:bigint,item_id:string,item_start:bigint,words:bigint>"
FOUND = f"n_words long, spans array<struct<start:long,end:long>>, items array<string>, matches array<{MATCH}>"


def word_pieces(text: bytes):
    """Lists of the words of a text, a few megabytes at a time."""
    text = text.translate(_FOLD)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


class Tests:
    """The windows of one block of stretches ``(item_id, offset, words)``."""

    def __init__(self, stretches, window: int):
        self.vocabulary: dict[bytes, int] = {}
        ids, starts, lengths, owner, offset, names = [], [], [], [], [], {}
        for item, first, words in stretches:
            own = [self.vocabulary.setdefault(w.encode(), len(self.vocabulary) + 1) for w in words]
            last = max(len(own) - window, 0)
            starts.extend(range(len(ids), len(ids) + last + 1))
            lengths.extend([min(window, len(own))] * (last + 1))
            owner.extend([names.setdefault(item, len(names))] * (last + 1))
            offset.extend(range(first, first + last + 1))
            ids.extend([*own, 0])
        self.names = list(names)
        self.ids = np.array(ids, np.int64)
        starts, lengths, owner = (np.array(a, np.int64) for a in (starts, lengths, owner))
        self.depth = int(lengths.max(initial=0))
        # equal windows are one query; its places in the items are a slice of `owner` and `offset`
        padded = np.concatenate([self.ids, np.zeros(window, np.int64)])
        grams = padded[starts[:, None] + np.arange(window)]
        grams[np.arange(window) >= lengths[:, None]] = 0
        _, first, which = np.unique(np.column_stack([lengths, grams]), axis=0, return_index=True, return_inverse=True)
        by = np.lexsort((offset, owner, which.ravel()))
        self.bounds = np.searchsorted(which.ravel()[by], np.arange(len(first) + 1))
        self.owner, self.offset = owner[by], np.array(offset, np.int64)[by]
        self.starts, self.lengths = starts[first], lengths[first]
        self.shortest = int(lengths.min()) if len(lengths) else window


def packed(ids: np.ndarray) -> np.ndarray:
    """Three words from each place on, as one number; ``ids`` has two more entries than the result."""
    return ids[:-2] << (2 * BITS) | ids[1:-1] << BITS | ids[2:]


def suffix_array(ids: np.ndarray, key: np.ndarray, n: int, shortest: int, depth: int) -> np.ndarray:
    """Places before ``n`` whose suffix begins with ``shortest`` known words, in the order of their next ``depth`` words.

    All known places are ranked, as ranks at later places refine earlier ones.
    """
    places = np.flatnonzero(ids[:len(key)])
    order = places[np.argsort(key[places], kind="stable")]
    rank = np.zeros(len(key) + max(depth, 3) + 1, np.int64)
    new = np.concatenate([[True], key[order[1:]] != key[order[:-1]]]) if len(order) else np.zeros(0, bool)
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) if len(order) else new
    rank[order] = head + 1
    seen = 3
    while seen < depth:
        tied = np.flatnonzero((head != np.arange(len(order))) | np.concatenate([head[1:] == head[:-1], [False]]))
        if not len(tied):
            break
        own = order[tied]
        later = rank[own + seen]
        by = np.lexsort((later, head[tied]))
        own, later, group = own[by], later[by], head[tied]
        order[tied] = own
        cut = np.concatenate([[True], (group[1:] != group[:-1]) | (later[1:] != later[:-1])])
        fresh = np.maximum.accumulate(np.where(cut, tied, 0))
        head[tied] = fresh
        rank[own] = fresh + 1
        seen *= 2
    zero = np.flatnonzero(ids == 0)
    run = zero[np.searchsorted(zero, order)] - order
    return order[(run >= shortest) & (order < n)]


def _bisect(key, sa, depth, lo, hi, value, right):
    """First place in each interval whose three words at ``depth`` are not less (``right``: greater) than ``value``."""
    lo, hi = lo.copy(), hi.copy()
    on = np.flatnonzero(lo < hi)
    while len(on):
        mid = (lo[on] + hi[on]) >> 1
        seen = key[np.minimum(sa[mid] + depth, len(key) - 1)]
        up = seen <= value[on] if right else seen < value[on]
        lo[on[up]] = mid[up] + 1
        hi[on[~up]] = mid[~up]
        on = on[lo[on] < hi[on]]
    return lo


def places(ids: np.ndarray, n: int, tests: Tests):
    """``(place, query)`` of every occurrence of a window of ``tests`` that begins before ``n`` in ``ids``."""
    ids = np.concatenate([ids, np.zeros(tests.depth + 6, np.int64)])
    key = packed(ids)
    sa = suffix_array(ids, key, n, tests.shortest, tests.depth)
    lo, hi = np.zeros(len(tests.starts), np.int64), np.full(len(tests.starts), len(sa), np.int64)
    query = np.concatenate([tests.ids, np.zeros(16, np.int64)])
    for depth in range(0, tests.depth, 3):
        on = np.flatnonzero((lo < hi) & (tests.lengths > depth))
        at, used = tests.starts[on] + depth, np.minimum(tests.lengths[on] - depth, 3)
        low = query[at] << (2 * BITS) | np.where(used > 1, query[at + 1], 0) << BITS | np.where(used > 2, query[at + 2], 0)
        high = low | (np.int64(1) << (BITS * (3 - used))) - 1
        a, b = lo[on], hi[on]
        lo[on] = _bisect(key, sa, depth, a, b, low, False)
        hi[on] = _bisect(key, sa, depth, a, b, high, True)
    found = np.flatnonzero(lo < hi)
    count = (hi - lo)[found]
    which = np.repeat(found, count)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    return sa[np.repeat(lo[found], count) + inside], which


def _hits(ids: np.ndarray, tests: Tests):
    """All occurrences in the words of one batch, shard by shard, in the order of their places."""
    at, which = [], []
    for first in range(0, len(ids), SHARD):
        x, q = places(ids[first:first + SHARD + tests.depth], min(SHARD, len(ids) - first), tests)
        at.append(x + first)
        which.append(q)
    at, which = np.concatenate(at), np.concatenate(which)
    by = np.lexsort((which, at))
    return at[by], which[by]


def _runs(at, which, place, tests: Tests):
    """Longest matches of occurrences ``(at, query, place in the items)``: those that follow one another in both texts are one."""
    owner, offset, length = tests.owner[place], tests.offset[place], tests.lengths[which]
    by = np.lexsort((at, offset - at, owner))
    a, o, f, length = at[by], owner[by], offset[by], length[by]
    cut = np.concatenate([[True], (o[1:] != o[:-1]) | ((f - a)[1:] != (f - a)[:-1]) | (a[1:] > a[:-1] + 1)])
    start = np.flatnonzero(cut)
    last = np.append(start[1:], len(a)) - 1
    return [(a[i], tests.names[o[i]], f[i], a[j] + length[j] - a[i]) for i, j in zip(start.tolist(), last.tolist())]


def _report(at: np.ndarray, which: np.ndarray, tests: Tests):
    """Spans, items and matches of one document; ``at`` counts from its first word."""
    ends = np.maximum.accumulate(at + tests.lengths[which])
    first = np.flatnonzero(np.concatenate([[True], at[1:] > ends[:-1]]))
    spans = [{"start": a, "end": b} for a, b in zip(at[first].tolist(), ends[np.append(first[1:], len(at)) - 1].tolist())]
    queries = np.unique(which)
    items = np.unique(np.concatenate([tests.owner[tests.bounds[q]:tests.bounds[q + 1]] for q in queries.tolist()]))
    count = tests.bounds[which + 1] - tests.bounds[which]
    total = int(count.sum())
    matches = []
    for own in [None] if total <= PAIRS else items.tolist():  # item by item where all at once are too many
        if own is None:
            row = np.repeat(np.arange(len(at)), count)
            place = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + tests.bounds[which][row]
        else:
            mine = np.flatnonzero(tests.owner == own)
            query = np.searchsorted(tests.bounds, mine, side="right") - 1
            lo, hi = np.searchsorted(query, which), np.searchsorted(query, which, side="right")
            row = np.repeat(np.arange(len(at)), hi - lo)
            place = mine[np.arange(len(row)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[row]]
        matches.extend(_runs(at[row], which[row], place, tests))
    matches = [dict(zip(("start", "item_id", "item_start", "words"), m)) for m in sorted(set(matches))]
    return spans, sorted(tests.names[i] for i in items.tolist()), matches


def _search(block):
    """The Arrow batch function ``(key.., text) -> (key.., FOUND)`` of one broadcast block."""
    def search(batches):
        tests = block.value
        get = tests.vocabulary.get
        for batch in batches:
            parts, sizes = [], []
            for text in batch.column(batch.num_columns - 1).cast(pa.binary()):
                size = 0
                for words in word_pieces(text.as_py() or b""):
                    parts.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
                    size += len(words)
                parts.append(np.zeros(1, np.int64))
                sizes.append(size)
            if not sizes:
                continue
            starts = np.cumsum([0, *(s + 1 for s in sizes)])
            at, which = _hits(np.concatenate(parts), tests)
            bounds = np.searchsorted(at, starts)
            rows = [_report(at[a:b] - s, which[a:b], tests) if b > a else ([], [], [])
                    for s, a, b in zip(starts.tolist(), bounds[:-1].tolist(), bounds[1:].tolist())]
            spans, items, matches = zip(*rows)
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            match = pa.struct([("start", pa.int64()), ("item_id", pa.string()), ("item_start", pa.int64()), ("words", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(span)),
                 pa.array(items, pa.list_(pa.string())), pa.array(matches, pa.list_(match))],
                names=[*batch.schema.names[:-1], "n_words", "spans", "items", "matches"])
    return search


def _stretches(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """``(item_id, first, words)``: every window of an item lies in one of its stretches."""
    def cut(batches):
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                words = [w.decode() for piece in word_pieces(text or b"") for w in piece]
                step = STRETCH - window + 1
                out.extend((item, i, words[i:i + STRETCH]) for i in range(0, max(len(words) - window + 1, min(len(words), 1)), step))
            items, first, words = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(first, pa.int64()), pa.array(words, pa.list_(pa.string()))],
                                             names=["item_id", "first", "words"])

    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, "item_id string, first long, words array<string>").distinct()


def _blocks(stretches: DataFrame, block_words: int):
    """The stretches with a block each, and the number of blocks, none of more than ``block_words`` words (but for a single stretch)."""
    total = stretches.agg(F.sum(F.size("words"))).first()[0] or 0
    n = max(1, -(-total // block_words))
    while True:
        dealt = stretches.withColumn("block", F.pmod(F.xxhash64("item_id", "first", "words"), F.lit(n)))
        most = dealt.groupBy("block").agg(F.sum(F.size("words")).alias("n"), F.count("*").alias("rows"))
        if n > total or most.where((F.col("n") > block_words) & (F.col("rows") > 1)).isEmpty():
            return dealt, n
        n *= 2


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
                  doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Where benchmark windows occur in each row of ``docs``.

    ``(doc_id, row_hash, n_words, spans, items, matches)``: ``spans`` are the
    maximal runs of words inside occurrences, ``items`` the sorted ids of the
    items with an occurring window, ``matches`` the longest verbatim matches,
    of at least a window, with each item and their places in both texts (a
    match is cut where a stretch of ``STRETCH`` words of an item ends). Words are
    runs of 0-9, a-z and non-ASCII characters, A-Z lower-cased. An item of
    fewer words than ``window`` is one window, one without words none. Null
    texts have no words. A null item id reads as an empty string, equal ids
    are one item; rows of ``docs`` with null or equal ids are judged one by
    one. Other columns are not read. Over one block of the benchmark nothing
    is shuffled; over several, rows with occurrences are merged by
    ``(doc_id, row_hash)``, two hashes of the text.
    """
    spark = docs.sparkSession
    row_hash = F.struct(F.xxhash64(doc_text).alias("a"), F.xxhash64(F.lit(window), doc_text).alias("b"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_hash.alias("row_hash"), F.col(doc_text).alias("text"))
    key = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, row_hash struct<a:long,b:long>"
    stretches, n = _blocks(stored(_stretches(benchmark, window, item_id, item_text), "stretches"), block_words)
    stretches = stored(stretches, "blocks") if n > 1 else stretches
    passes = []
    for i in range(n):
        own = stretches.where(F.col("block") == i).select("item_id", "first", "words").orderBy("item_id", "first").collect()
        block = spark.sparkContext.broadcast(Tests(own, window))
        passes.append(rows.mapInArrow(_search(block), f"{key}, {FOUND}"))
    if n == 1:
        return passes[0]
    # hits of all passes; the first pass also counts the words
    first = stored(passes[0], "pass")
    hits = [stored(p.where(F.size("spans") > 0), "pass") for p in passes[1:]]
    every = first.where(F.size("spans") > 0)
    for h in hits:
        every = every.unionByName(h)
    merged = every.groupBy("doc_id", "row_hash").agg(
        *(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("spans", "items", "matches")))
    span = "struct<start:bigint,end:bigint>"
    joined = F.expr(f"""aggregate(spans, cast(array() as array<{span}>), (done, s) ->
        if(size(done) > 0 and s.start <= element_at(done, -1).end,
           concat(slice(done, 1, size(done) - 1), array(named_struct('start', element_at(done, -1).start, 'end', greatest(element_at(done, -1).end, s.end)))),
           concat(done, array(s))))""")
    merged = merged.withColumn("spans", joined).withColumnsRenamed({"doc_id": "m_id", "row_hash": "m_hash"})
    left = first.select("doc_id", "row_hash", "n_words")
    on = (left.row_hash == merged.m_hash) & left.doc_id.eqNullSafe(merged.m_id)
    empty = {c: F.coalesce(c, F.expr(f"cast(array() as {t})")) for c, t in
             (("spans", f"array<{span}>"), ("items", "array<string>"), ("matches", f"array<{MATCH}>"))}
    return left.join(merged, on, "left").select("doc_id", "row_hash", "n_words", *(v.alias(c) for c, v in empty.items()))


def n_hit() -> F.Column:
    """Words of a row of ``find_passages`` inside any occurrence."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s.end - s.start)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without any occurrence of a window, with all their columns."""
    found = find_passages(docs, benchmark, **options).where(F.size("spans") > 0)
    gone = stored(found.select(F.col("row_hash.a").alias("gone_a"), F.col("row_hash.b").alias("gone_b")).distinct(), "leaks")
    text, window = options.get("doc_text", "text"), options.get("window", WINDOW)
    same = (F.xxhash64(docs[text]) == gone.gone_a) & (F.xxhash64(F.lit(window), docs[text]) == gone.gone_b)
    return docs.join(gone, same, "left_anti")
