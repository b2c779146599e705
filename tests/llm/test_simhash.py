import random
import re

import pytest
import xxhash

from tabml.llm import simhash_bktree as sb
from tabml.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_simhash(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(text)
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def plain_groups(values, near):
    """Component number of each place."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def check(df, data):
    rows = df.collect()
    fps = [plain_simhash(t) for _, t in data]
    groups = plain_groups(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for (i, _), g in zip(data, groups):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    want = sorted(((i, f, least[g]) for (i, _), f, g in zip(data, fps, groups)), key=str)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in rows), key=str) == want


def test_whole_table(spark, sf_tiny):
    docs = spark.read.parquet(f"{sf_tiny}/documents.parquet")
    check(sb.near_duplicates(docs), [tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_odd_rows(make_docs):
    rng = random.Random(1)
    words = ["alpha", "beta", "gamma", "delta", "É", "THE", "of", "a b"]
    base = [rng.choice(words) + str(rng.randint(0, 400)) for _ in range(400)]
    data = [(9, None), (8, ""), (7, " \t\n"), (6, "one"), (5, "ONE"), (5, "ONE"), (4, "one two"), (None, "one"), (None, "lonely unnamed text here")]
    for i in range(25):
        edited = list(base)
        for _ in range(i % 4):
            edited[rng.randrange(400)] = "edit"
        data.append((100 + i, " ".join(edited)))
    data.append((300, "very long text " * 30_000))
    check(sb.near_duplicates(make_docs(data)), data)


def test_empty_table(make_docs):
    assert sb.near_duplicates(make_docs([(1, "x")]).where("false")).count() == 0


@pytest.mark.parametrize("most", [4, 1024])
def test_large_shards_are_split_and_lose_no_link(spark, monkeypatch, most):
    """Chains of single-bit steps around a few centres; with trees of at most 4 values the shards split to the end."""
    monkeypatch.setattr(sb, "MAX_TREE", most)
    rng = random.Random(5)
    values = set()
    for _ in range(6):
        v = rng.getrandbits(64)
        for _ in range(60):
            values.add(v)
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 5])):
                v ^= 1 << b
    values = sorted(values)
    df = spark.createDataFrame([(sb._signed(v),) for v in values], "fp long")
    got = {r.node % (1 << 64): r.component for r in components(sb.links(df)).collect()}
    groups = plain_groups(values, lambda a, b: (a ^ b).bit_count() <= 3)
    named = {}
    for v, g in zip(values, groups):
        named.setdefault(g, set()).add(got.get(v, ("alone", v)))
    assert all(len(x) == 1 for x in named.values())
    assert len({next(iter(x)) for x in named.values()}) == len(named)


def test_tree_finds_all_within_the_radius():
    rng = random.Random(2)
    values = [rng.getrandbits(12) for _ in range(300)]
    tree = sb.BkTree()
    for i, v in enumerate(values):
        assert sorted(tree.near(v, 3)) == [j for j in range(i) if (values[j] ^ v).bit_count() <= 3]
        tree.add(v)


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, 5000 + i) for i in range(200)]
    df = spark.createDataFrame([*edges, (None, 3), (7, None)], "a long, b long")
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = sorted((r.node, r.component) for r in components(df).collect())
    assert got == sorted((x, find(x)) for x in list(root))
    assert components(df.where("false")).count() == 0
