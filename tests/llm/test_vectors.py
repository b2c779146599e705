import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml.llm import pstable


def plain(data, threshold):
    """(id, links, component) by all pairs of equal label and length."""
    usable = []
    for i, (_, label, v) in enumerate(data):
        x = None if v is None or label is None or any(c is None for c in v) else np.array(v, float)
        usable.append(x if x is not None and len(x) and np.isfinite(x).all() and x.any() else None)
    n = len(data)
    links = [[] for _ in range(n)]
    for i in range(n):
        for j in range(i):
            a, b = usable[i], usable[j]
            if a is not None and b is not None and data[i][1] == data[j][1] and len(a) == len(b):
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                    links[i].append(j)
                    links[j].append(i)
    out, comp = [], {}
    for i in range(n):
        if i not in comp:
            todo, seen = [i], {i}
            while todo:
                for j in links[todo.pop()]:
                    if j not in seen:
                        seen.add(j)
                        todo.append(j)
            least = min((data[j][0] for j in seen if data[j][0] is not None), default=None)
            comp |= {j: least for j in seen}
        out.append((data[i][0], len(links[i]), comp[i]))
    return out


def frame(spark, data):
    return spark.createDataFrame([(i, v, lab) for i, lab, v in data], "vec_id long, embedding array<double>, label int").withColumns(
        {c: F.lit("x") for c in ("h", "rid", "vector", "keys", "block")})


def cluster(rng, n, dim, spread):
    centre = rng.standard_normal(dim)
    return [(centre / np.linalg.norm(centre) + spread * rng.standard_normal(dim) / np.sqrt(dim)).tolist() for _ in range(n)]


@pytest.mark.parametrize("cell", [1024, 8])
def test_against_all_pairs(spark, cell):
    """Clusters well inside the threshold, copies and odd rows; with cells of 8 rows every bucket is cut into blocks."""
    rng = np.random.default_rng(3)
    data = []
    for c in range(6):
        data += [(100 * c + i, c % 2, v) for i, v in enumerate(cluster(rng, 30, 16, 0.05))]
    same = rng.standard_normal(16).tolist()
    data += [(1000 + i, 1, same) for i in range(20)] + [(1000, 1, same), (None, 1, same), (2000, 0, same)]
    data += [(3000, 1, None), (3001, None, same), (3002, 1, [0.0] * 16), (3003, 1, [float("nan")] + same[1:]), (3004, 1, [float("inf")] + same[1:]),
             (3005, 1, [None] + same[1:]), (3006, 1, []), (3007, 1, same[:8]), (3008, 1, [1e100 * x for x in same]), (None, 1, None)]
    got = pstable.near_vectors(frame(spark, data), cell=cell).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == sorted(plain(data, 0.98), key=str)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_whole_table_finds_nine_tenths(spark, sf_tiny):
    """Recall against brute force at the threshold; nothing below it."""
    table = spark.read.parquet(f"{sf_tiny}/embeddings.parquet")
    data = [(r.vec_id, r.label, r.embedding) for r in table.collect()]
    got = {r.vec_id: r for r in pstable.near_vectors(table).collect()}
    want = plain(data, 0.98)
    assert len(got) == len(want)
    assert all(got[i].n_links <= n for i, n, _ in want)
    assert sum(r.n_links for r in got.values()) >= 0.9 * sum(n for _, n, _ in want)


def test_recall_at_the_threshold(spark):
    """Pairs of a cosine just over the threshold, where hashing is least sure."""
    rng = np.random.default_rng(8)
    data = []
    for i in range(300):
        a, b = np.linalg.qr(rng.standard_normal((64, 2)))[0].T
        data += [(2 * i, 1, a.tolist()), (2 * i + 1, 1, (0.981 * a + np.sqrt(1 - 0.981 ** 2) * b).tolist())]
    got = pstable.near_vectors(frame(spark, data)).collect()
    assert sum(r.n_links for r in got) >= 0.9 * 600


def test_empty_table(spark):
    assert pstable.near_vectors(frame(spark, [(1, 1, [1.0])]).where("false")).count() == 0
