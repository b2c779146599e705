import random
import re

import pytest
from pyspark.sql import functions as F

from tabml.llm import suffix_search as ss

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(docs, items, window=10):
    """(doc_id, n_words, hit places, items, longest) by comparing every place with every window."""
    grams = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - window + 1, min(len(w), 1))):
            grams.setdefault(tuple(w[i:i + window]), set()).add("" if item is None else str(item))
    sizes = {len(g) for g in grams}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, named = set(), set()
        for i in range(len(w)):
            for k in sizes:
                if len(w) - i >= k and tuple(w[i:i + k]) in grams:
                    hit.update(range(i, i + k))
                    named |= grams[tuple(w[i:i + k])]
        longest = 0
        for _, t in items:
            b = words(t)
            ends = [0] * (len(b) + 1)
            for x in w:
                ends = [0, *(ends[j] + 1 if x == y else 0 for j, y in enumerate(b))]
                longest = max([longest, *(e for e in ends if e >= min(window, len(b)))])
        out.append((doc, len(w), tuple(sorted(hit)), tuple(sorted(named)), longest))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_words, tuple(i for s in r.spans for i in range(s.start, s.end)), tuple(r["items"]),
                    max((m.words for m in r.matches), default=0)) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)] + ["été", "a1", "文字"]
    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))
    shared = text(14)
    items = [(i, text(rng.randint(8, 60))) for i in range(30)]
    items += [(100 + i, f"{text(5)} {shared} {text(rng.randint(0, 9))}") for i in range(12)]
    items += [(200, "w1 w2"), (201, "w3"), (202, "W3!"), (203, ""), (204, None), (205, "..."), (None, text(12)), (5, text(11)), (6, items[6][1]), (7, items[8][1])]
    docs = []
    for i in range(60):
        a = rng.choice(items)[1] or ""
        w = a.split()
        cut = rng.randint(0, max(len(w) - 1, 0))
        docs.append((i, f"{text(rng.randint(0, 80))} {' '.join(w[cut:])} {text(rng.randint(0, 30))}"))
    docs += [(100 + i, "Some, " + (items[3][1] or "").upper().replace(" ", " -- ") + " tail.") for i in range(40)]  # copies
    docs += [(200, None), (201, ""), (202, " \n"), (203, "w3"), (204, shared * 3), (None, items[0][1]), (0, items[1][1]), (300, " ".join([shared] * 40)),
             (301, text(3000) + " " + items[9][1] + " " + text(2000))]
    return docs, items


def frames(spark, make_docs, corpus):
    docs, items = corpus
    bench = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, words string, block int")
    return make_docs(docs).withColumns({c: F.lit("x") for c in ("spans", "items", "matches", "n_words", "gone_a")}), bench


@pytest.mark.parametrize("block, shard, pairs", [(200_000, 1 << 20, 1 << 20), (300, 1 << 20, 1 << 20), (200_000, 700, 5)])
def test_against_every_place(spark, make_docs, corpus, monkeypatch, block, shard, pairs):
    """One block or several; shards of 700 places, which cut documents and passages; items taken one by one."""
    if shard == 700:  # tasks see the module's own constants, so the small ones are tried in this process
        monkeypatch.setattr(ss, "SHARD", shard)
        monkeypatch.setattr(ss, "PAIRS", pairs)
        got = in_process(*corpus)
    else:
        docs, bench = frames(spark, make_docs, corpus)
        got = found(ss.find_passages(docs, bench, block_words=block))
    assert got == plain(*corpus)


def in_process(docs, items):
    import pyarrow as pa

    stretches = [("" if i is None else str(i), 0, words(t)) for i, t in items if words(t)]

    class Block:
        value = ss.Tests(stretches, 10)

    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs]), pa.array([t for _, t in docs], pa.string())], names=["doc_id", "text"])
    out = next(ss._search(Block)(iter([batch]))).to_pylist()
    return sorted(((r["doc_id"], r["n_words"], tuple(i for s in r["spans"] for i in range(s["start"], s["end"])), tuple(r["items"]),
                    max((m["words"] for m in r["matches"]), default=0)) for r in out), key=str)


def test_places_of_matches(spark, make_docs, corpus):
    docs, bench = frames(spark, make_docs, corpus)
    texts = {}
    for i, t in corpus[1]:
        texts.setdefault("" if i is None else str(i), []).append(words(t))
    own = {}
    for i, t in corpus[0]:
        own.setdefault(i, []).append(words(t))
    n = 0
    for r in ss.find_passages(docs, bench).collect():
        for m in r.matches:
            n += 1
            assert any(w[m.start:m.start + m.words] == b[m.item_start:m.item_start + m.words] and len(b) >= m.item_start + m.words
                       for w in own[r.doc_id] for b in texts[m.item_id])
    assert n > 60


def test_decontaminate(spark, make_docs, corpus):
    docs, bench = frames(spark, make_docs, corpus)
    clean = ss.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(r[0]) for r in plain(*corpus) if not r[2])


def test_long_items_are_cut_into_stretches(spark, make_docs):
    rng = random.Random(1)
    w = [f"v{rng.randrange(10 ** 6)}" for _ in range(ss.STRETCH * 3 + 5)]
    items = spark.createDataFrame([("long", " ".join(w))], "item_id string, text string")
    docs = [(1, " ".join(w)), *((i, " ".join(["x", *w[k:k + 10], "y"])) for i, k in enumerate((0, ss.STRETCH - 5, ss.STRETCH - 9, len(w) - 10), 2)), (9, " ".join(w[:9]))]
    got = {r.doc_id: sum(s.end - s.start for s in r.spans) for r in ss.find_passages(make_docs(docs), items, block_words=2500).collect()}
    assert got == {1: len(w), 2: 10, 3: 10, 4: 10, 5: 10, 9: 0}


def test_empty_tables(spark, make_docs, corpus):
    docs, bench = frames(spark, make_docs, corpus)
    assert ss.find_passages(docs.where("false"), bench).count() == 0
    assert ss.find_passages(docs, bench.where("false")).where("size(spans) > 0").count() == 0


def test_words_of_a_text_in_pieces(monkeypatch):
    text = "".join(random.Random(2).choice("aB7 .\né文") for _ in range(5000))
    want = [w.encode() for w in words(text)]
    monkeypatch.setattr(ss, "PIECE", 50)
    assert [w for piece in ss.word_pieces(text.encode()) for w in piece] == want
