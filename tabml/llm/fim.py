"""Fill-in-middle forms of documents, cut at unit ranks found in an indexable skip list.

A text's units (lines) are the links of the list's lowest lane. Each lane above
holds about a quarter of the nodes below it, picked by a hash of the rank, and
each link carries two widths: the units and the code points that it passes. A
cut at a rank is found from the top lane down, by taking links as long as the
units passed do not exceed the rank; the code points passed are the cut.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINES = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A batch of results is handed on when it holds so many code points.
OUT_CHARS = 8_000_000


class SkipList:
    """The units of one text by rank."""

    def __init__(self, points: np.ndarray):
        """``points``: the code-point width of each unit."""
        n = len(points)
        # the tail (rank n) is on every lane, as the head is; a node's height grows by one with probability 1/4
        mix = (np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mix = (mix ^ (mix >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(16)
        at, units = np.arange(n), np.ones(n, np.int64)
        self.lanes = [(None, units.tolist(), points.tolist())]
        while len(at) > 4:
            stays = (mix[at] & np.uint64(3)) == 0
            mix >>= np.uint64(2)
            stays[0] = True
            down = np.flatnonzero(stays)
            if len(down) == len(at):
                break
            units, points = np.add.reduceat(units, down), np.add.reduceat(points, down)
            self.lanes.append(([*down.tolist(), len(at)], units.tolist(), points.tolist()))
            at = at[down]

    def before(self, rank: int) -> int:
        """Code points before the unit of this rank."""
        passed = points = link = 0
        for down, units, widths in reversed(self.lanes):
            while link < len(units) and passed + units[link] <= rank:
                passed += units[link]
                points += widths[link]
                link += 1
            if down is not None:
                link = down[link]
        return points


def arrange(text: str, key: str, unit: re.Pattern, rate: int, spm: int):
    """``(n, form, prefix code points, middle code points, output)`` of one text."""
    points = np.array([len(m) for m in unit.findall(text)], np.int64)
    n = len(points)
    if points.sum() != len(text):
        raise ValueError("the units must cover the text")
    digest = hashlib.sha256(key.encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or h3 % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    units = SkipList(points)
    a, b = (units.before(r) for r in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, unit: str = LINES,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` for every row of ``docs``.

    The cuts and the form follow from the sha256 of ``seed:doc_id`` alone:
    ``rate`` percent of the rows are rearranged, ``spm`` percent of these with
    the suffix first. ``unit`` is a pattern without groups whose matches cover
    every text. A null text is empty; empty texts, and texts that hold a
    marker, stay plain, with null ``prefix_chars`` and ``middle_chars``. A null
    id reads as an empty string; rows of one id are cut by the same hash, each
    by its own number of units. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("key"),
                       F.coalesce(text_col, F.lit("")).alias("text"))

    def arranged(batches):
        pattern = re.compile(unit)
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        for batch in batches:
            out, first, held = [], 0, 0
            for i in range(batch.num_rows):
                out.append(arrange(batch.column(2)[i].as_py(), batch.column(1)[i].as_py(), pattern, rate, spm))
                held += len(out[-1][-1])
                if held > OUT_CHARS or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(out)),
                                                      *(pa.array(c, t) for c, t in zip(zip(*out), types))], names=names)
                    out, first, held = [], i + 1, 0

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(arranged, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` rearranged: no part holds a marker, so the first of each ends one."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    spm = form == "spm"
    return F.when(form == "plain", output).otherwise(
        F.concat(F.when(spm, parts[2]).otherwise(parts[1]), parts[3], F.when(spm, parts[1]).otherwise(parts[2])))
