import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml.llm import fim

ODD = [(1, ""), (2, None), (3, "one line"), (4, "\n"), (5, "\n\n\n"), (6, "a\nb\nc\n"), (7, "a\r\nb c\x0bd\ne"), (8, "kept <P> plain\nx"),
       (9, "<M>"), (10, "<S\n>P><\n<\n>"), (11, "\U0001F600\né́x\n" * 50), (12, "long line " * 20_000 + "\n" + "x\n" * 30_000),
       (None, "no id\nat all\n"), (6, "a\nb\nc\n"), (6, "other text\nof the same id\n"), (-13, "negative\nid\n")]


def plain(doc_id, text):
    """The contract, by slicing."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    n = len(lines)
    if not text or re.search("<[PSM]>", text):
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h4 % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def rows(df):
    return sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in df.collect()), key=str)


def test_odd_texts(spark, make_docs):
    docs = make_docs(ODD).withColumns({c: F.lit("clash") for c in ("n", "form", "output", "key", "prefix_chars")})
    got = fim.fill_in_middle(docs)
    assert rows(got) == sorted(((i, *plain(i, t)) for i, t in ODD), key=str)
    back = got.select("doc_id", fim.restored(F.col("output"), F.col("form")).alias("t")).collect()
    assert sorted(map(str, ((r.doc_id, r.t) for r in back))) == sorted(map(str, ((i, t or "") for i, t in ODD)))


def test_empty_table(spark, make_docs):
    assert fim.fill_in_middle(make_docs(ODD[:1]).where("false")).count() == 0


def test_whole_table(spark, sf_tiny):
    docs = spark.read.parquet(f"{sf_tiny}/documents.parquet")
    assert rows(fim.fill_in_middle(docs)) == sorted(((r.doc_id, *plain(r.doc_id, r.text)) for r in docs.collect()), key=str)


def test_rates_and_units(spark, make_docs):
    docs = make_docs([(i, f"some words of text {i} here") for i in range(400)])
    forms = {r.form: r["count"] for r in fim.fill_in_middle(docs, rate=50, spm=0, unit=r"\S+\s*").groupBy("form").count().collect()}
    assert set(forms) == {"plain", "psm"} and 150 < forms["plain"] < 250
    cut = fim.fill_in_middle(docs, unit=r"\S+\s*").where("form <> 'plain'")
    assert cut.select(F.max("n")).first()[0] == 6 and cut.where("prefix_chars + middle_chars not in (0, 5, 11, 14, 19) and prefix_chars + middle_chars < 19").count() == 0
    assert cut.where(fim.restored(F.col("output"), F.col("form")).like("some words of text % here")).count() == cut.count()


@pytest.mark.parametrize("n", [0, 1, 4, 5, 37, 5000])
def test_every_rank(n):
    widths = np.random.default_rng(n).integers(0, 50, n)
    units, total = fim.SkipList(widths), np.concatenate([[0], np.cumsum(widths)])
    assert [units.before(r) for r in range(n + 1)] == total.tolist()


def test_lanes_thin_out():
    units = fim.SkipList(np.ones(100_000, np.int64))
    sizes = [len(lane[1]) for lane in units.lanes]
    assert all(0.2 < b / a < 0.3 for a, b in zip(sizes, sizes[1:]) if a > 2000) and sizes[-1] < 60
    assert all(sum(lane[1]) == sum(lane[2]) == 100_000 for lane in units.lanes)
