"""Sequence packing by the online sum-of-squares rule.

Every task packs the documents of its own input split, so nothing is shuffled
and no state crosses tasks. A level array holds, for each fill 1 .. W-1, how
many windows are open at that fill. A document (its tokens beyond whole
windows) goes to the fill level, or a new window, that leaves the smallest sum
of squared level counts; ties go to the fullest level. Windows that reach W are
closed. When a task ends, or holds ``max_open`` windows, the emptiest windows
are cut up to fill the others; a task's last window is cut at powers of two,
which need no padding. So each task pads nothing, and holds at most
``max_open`` windows of W ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .wordbpe import word_bpe

#: sequence_id = input split << SPLIT_BITS | window within the split
SPLIT_BITS = 36


class LevelPacker:
    """Packs pieces ``(doc, start, ids, doc_tokens)`` into windows of ``window`` ids.

    ``emit(pieces)`` gets the pieces of each closed window in order.
    """

    def __init__(self, window: int, emit, max_open: int = 4096):
        self.window, self.emit, self.max_open = window, emit, max_open
        self.count = np.zeros(window + 1, np.int64)
        self.levels: list[list[list]] = [[] for _ in range(window + 1)]
        self.n_open = 0

    def choose(self, size: int) -> int:
        """Fill level (0: a new window) that minimises the sum of squared counts."""
        n, w = self.count, self.window
        levels = np.flatnonzero(n[1:w - size + 1]) + 1
        best, change = 0, 2 * int(n[size]) + 1
        if len(levels):
            grown = 2 * (n[levels + size] - n[levels] + 1)
            if levels[-1] + size == w:
                grown[-1] = 1 - 2 * n[levels[-1]]
            k = len(levels) - 1 - int(np.argmin(grown[::-1]))
            if grown[k] <= change:
                best = int(levels[k])
        return best

    def _open(self, level: int, pieces: list) -> None:
        self.levels[level].append(pieces)
        self.count[level] += 1
        self.n_open += 1

    def _take(self, level: int) -> list:
        self.count[level] -= 1
        self.n_open -= 1
        return self.levels[level].pop()

    def add(self, doc, ids: np.ndarray) -> None:
        w, n = self.window, len(ids)
        whole = n - n % w
        for at in range(0, whole, w):
            self.emit([(doc, at, ids[at:at + w], n)])
        if whole == n:
            return
        piece, size = (doc, whole, ids[whole:], n), n - whole
        level = self.choose(size)
        pieces = self._take(level) if level else []
        pieces.append(piece)
        if level + size == w:
            self.emit(pieces)
        else:
            self._open(level + size, pieces)
            if self.n_open > self.max_open:
                self.drain(last=False)

    def drain(self, last: bool) -> None:
        """Fill the fullest windows with cuts of the emptiest ones."""
        held = [p for level in range(self.window - 1, 0, -1) for p in self.levels[level]]
        self.levels = [[] for _ in range(self.window + 1)]
        self.count[:] = 0
        self.n_open = 0
        i, j = 0, len(held) - 1
        while i < j:
            gap = self.window - sum(len(p[2]) for p in held[i])
            while gap and i < j:
                doc, start, ids, n = held[j].pop()
                held[i].append((doc, start, ids[:gap], n))
                if len(ids) > gap:
                    held[j].append((doc, start + gap, ids[gap:], n))
                gap -= len(held[i][-1][2])
                if not held[j]:
                    j -= 1
            if not gap:
                self.emit(held[i])
                i += 1
        if i != j:
            return
        rest, size = held[i], sum(len(p[2]) for p in held[i])
        if size == self.window:
            self.emit(rest)
        elif not last:
            self._open(size, rest)
        else:
            rest.reverse()
            while size:
                part = want = 1 << size.bit_length() - 1
                out = []
                while want:
                    doc, start, ids, n = rest.pop()
                    out.append((doc, start, ids[:want], n))
                    if len(ids) > want:
                        rest.append((doc, start + want, ids[want:], n))
                    want -= len(out[-1][2])
                self.emit(out)
                size -= part


#: Pieces, of up to a window of ids each, in one batch of results.
OUT_ROWS = 1024


def pack(docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text", max_open: int = 4096, as_list: bool = False) -> DataFrame:
    """Pack the token ids of all documents into windows of at most ``window`` ids.

    One row per piece: ``doc_id, start, length, ids (binary, little-endian uint32, or with
    as_list array<int>), doc_tokens, sequence_id, offset``. A null text is an empty text: its document
    is the end id alone. A null id is kept as it is; repeated rows are separate
    documents; other columns are not read. An empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType()) if as_list else T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType())])

    def run(batches):
        bpe, out, spare = word_bpe(tokenizer_path), [], [TaskContext.get().partitionId() << SPLIT_BITS]

        def emit(pieces):
            seq, at = spare[0], 0
            for doc, start, ids, n in pieces:
                out.append((doc, start, len(ids), ids.astype(np.int32) if as_list else ids.tobytes(), n, seq, at))
                at += len(ids)
            spare[0] += 1

        def rows(kind):
            cols = [list(c) for c in zip(*out)]
            out.clear()
            types = [kind, pa.int64(), pa.int64(), pa.list_(pa.int32()) if as_list else pa.binary(), *[pa.int64()] * 3]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=schema.fieldNames())

        packer, kind = LevelPacker(window, emit, max_open), None
        for batch in batches:
            kind = batch.schema.field(0).type
            end = np.array([end_id], np.uint32)
            for doc, ids in zip(batch.column(0).to_pylist(), bpe.encode(batch.column(1))):
                packer.add(doc, np.concatenate([ids, end]))
                if len(out) >= OUT_ROWS:
                    yield rows(kind)
        packer.drain(last=True)
        if out:
            yield rows(kind)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
