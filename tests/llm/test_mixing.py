import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabml.llm import mixing


def words(text):
    return re.findall(mixing.WORD, text or "")


def check(docs, data, mixed, block=128):
    """data: (doc_id, text, source)."""
    rows = mixed.documents.collect()
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter((i, s, len(words(t))) for i, t, s in data)
    size = defaultdict(int)
    for _, t, s in data:
        size[s] += len(words(t))
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == size[r.source]
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    goal = {r.source: r.target for r in rows}
    assert abs(sum(goal.values()) - sum(size.values())) < 1e-6 * max(1, sum(size.values()))
    for s, t in goal.items():
        assert t <= 3 * size[s] + 1e-6
        assert abs(taken[s] - t) <= 2 * block + 0.02 * t, (s, taken[s], t)
    return rows


def test_whole_table(spark, sf_tiny):
    docs = spark.read.parquet(f"{sf_tiny}/documents.parquet")
    data = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    rows = check(docs, data, mixing.mix(docs))
    again = mixing.mix(docs.repartition(7)).documents.collect()
    key = lambda r: (str(r.doc_id), r.row_hash, r.dup)
    assert sorted(rows, key=key) == sorted(again, key=key)


def test_odd_rows(make_docs):
    data = [(None, "no id " * 50, "en", "b"), (1, None, "en", "a"), (2, "", "en", "a"), (3, "x y z " * 400, "en", "a"), (3, "x y z " * 400, "en", "a"),
            (4, "w" * 50_000 + " tail", "en", None), (5, "null source " * 300, "en", None), (6, " \t\n", "en", "empty"), (7, "one", "en", "é"),
            (8, "big " * 40_000, "en", "Z")]
    mixed = mixing.mix(make_docs(data), block=16, shard_slots=64)
    rows = check(None, [(d[0], d[1], d[3]) for d in data], mixed, block=16)
    # code point order, null last: Z, a, b, empty, é, null weigh 5, 2, 1, 5, 2, 1
    sizes = {r.source: r.source_size for r in rows}
    order = ["Z", "a", "b", "empty", "é", None]
    want = mixing.targets(np.array([sizes[s] for s in order]), np.resize([5.0, 2.0, 1.0], 6), 3)
    assert {r.source: r.target for r in rows} == pytest.approx(dict(zip(order, want)))
    # a shard's positions are gapless, and a block's pieces hold its words once for each slot
    pieces = mixed.pieces.collect()
    slots = defaultdict(set)
    for p in pieces:
        slots[p.shard].add(p.position)
    assert all(s == set(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) <= 64


def test_targets():
    assert mixing.targets(np.array([100, 100, 100]), np.array([5.0, 2, 1]), 3).tolist() == pytest.approx([187.5, 75, 37.5])
    out = mixing.targets(np.array([10, 1000, 10]), np.array([5.0, 2, 1]), 3)
    assert out.tolist() == pytest.approx([30, 960, 30])
    assert mixing.targets(np.array([0, 0]), np.array([5.0, 2]), 3).tolist() == [0, 0]
    assert mixing.targets(np.array([0, 7]), np.array([5.0, 2]), 3).tolist() == pytest.approx([0, 7])


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 4097])
def test_permutations(n):
    for key in (1, 99):
        out = mixing.permuted(np.arange(n), n, np.full(n, key, np.uint64))
        assert sorted(out.tolist()) == list(range(n))
    if n >= 1000:
        assert abs(np.corrcoef(np.arange(n), out)[0, 1]) < 0.15


def test_draw_keeps_to_what_is_left():
    rng = np.random.default_rng(1)
    left = np.array([5, 0, 1000, 1])
    while left.sum():
        n = mixing.draw(rng, left, min(100, int(left.sum())))
        assert (n <= left).all() and n.sum() == min(100, left.sum())
        left = left - n


@pytest.mark.parametrize("groups", [1, 2, 3, 7, 64])
def test_groups_share_all_slots(groups):
    """What the groups of shards draw apart adds up: full groups but the last, every source's quota met, starts in order."""
    rng = np.random.default_rng(groups)
    quota = rng.integers(0, 400, 50) * (rng.random(50) < 0.6)
    quota[7] = 12_000  # a hot source
    slots = -(-int(quota.sum()) // groups)
    groups = -(-int(quota.sum()) // slots)
    before = np.zeros_like(quota)
    for g in range(groups):
        n, first = mixing.share(quota, g, groups, slots, 17)
        assert (first == before).all() and (n >= 0).all()
        assert n.sum() == (slots if g < groups - 1 else quota.sum() - slots * (groups - 1))
        # each group holds the sources in about their proportion
        assert abs(n[7] - n.sum() * quota[7] / quota.sum()) <= 6 * np.sqrt(n.sum()) + 1
        before = before + n
    assert (before == quota).all()


def test_many_sources(make_docs, monkeypatch):
    """More sources than are broadcast: the same result by a shuffle, a hot source and the null one among them."""
    data = [(i, "w " * (5 + i % 40), "en", f"s{i % 300:03d}" if i % 3 else "s000" if i % 2 else None) for i in range(900)]
    docs = make_docs(data)
    key = lambda r: (r.doc_id, r.row_hash, r.dup)
    small = sorted(mixing.mix(docs, block=4, shard_slots=64).documents.collect(), key=key)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 10)
    mixed = mixing.mix(docs, block=4, shard_slots=64)
    assert sorted(check(None, [(d[0], d[1], d[3]) for d in data], mixed, block=4), key=key) == small


def test_mixed_texts(make_docs):
    data = [(i, " ".join(f"d{i}w{j}" for j in range(40 + 7 * i)), "fr", f"s{i % 4}") for i in range(30)] + [(3, "", "en", "s1"), (4, None, "en", "s1")]
    docs = make_docs(data)
    mixed = mixing.mix(docs, block=16, shard_slots=32)
    rows = mixing.mixed_texts(docs, mixed).collect()
    assert rows[0].__fields__ == docs.columns
    got = Counter()
    for r in rows:
        w = words(r.text)
        assert len(set(w)) == len(w) and all(x.startswith(f"d{r.doc_id}w") for x in w)
        assert [int(x.split("w")[1]) for x in w] == sorted(int(x.split("w")[1]) for x in w)
        got[r.doc_id] += len(w)
    want = Counter()
    for r in mixed.documents.collect():
        want[r.doc_id] += r.taken
    assert +got == +want


def test_shard_texts(make_docs):
    """The shards' words, slot by slot, are those that the pieces name, and each row is a passage of its document."""
    data = [(i, " \n".join(f"d{i}w{j}" for j in range(40 + 7 * i)), "fr", f"s{i % 4}") for i in range(30)] + [
        (3, "", "en", "s1"), (4, None, "en", "s1"), (5, "one two three", "en", None), (5, "one two three", "en", None)]
    docs = make_docs(data)
    mixed = mixing.mix(docs, block=16, shard_slots=32)
    rows = mixing.shard_texts(docs, mixed)
    assert rows.columns == docs.columns
    whole = defaultdict(list)
    for i, t, *_ in data:
        whole[i].append(t or "")
    want, total = defaultdict(list), 0
    for p in sorted(mixed.pieces.collect(), key=lambda p: (p.shard, p.position, p.at)):
        if p.doc_id != 5:
            want[p.shard] += [f"d{p.doc_id}w{j}" for j in range(p.start, p.start + p.n_words)]
        total += p.n_words
    got = []
    for part in rows.rdd.glom().collect():
        got.append([w for r in part if r.doc_id != 5 for w in words(r.text)])
        assert all(any(r.text in t for t in whole[r.doc_id]) and r.text for r in part)
    # a partition holds whole shards, in order
    for part in got:
        for shard in sorted(want):
            if part[:len(want[shard])] == want[shard] and want[shard]:
                part = part[len(want[shard]):]
                del want[shard]
        assert part == []
    assert not any(want.values())
    assert sum(len(words(r.text)) for r in rows.collect()) == total == sum(r.taken for r in mixed.documents.collect())


def test_empty_table(make_docs):
    docs = make_docs([(1, "x")]).where("false")
    mixed = mixing.mix(docs)
    assert mixed.documents.count() == 0 and mixed.pieces.count() == 0 and mixing.mixed_texts(docs, mixed).count() == mixing.shard_texts(docs, mixed).count() == 0
