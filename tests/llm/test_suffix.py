import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tabml.llm import queries
from tabml.llm import suffix_refine as sr


def plain(texts, length):
    """(n_bytes, spans, kept) per text by counting all windows."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out.append((len(b), list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())),
                    np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


def check(df, data, length):
    got = sorted((str(r.doc_id), r.n_bytes, [(s.first, s.end) for s in r.removed], bytes(r.kept)) for r in df.collect())
    assert got == sorted((str(i), *p) for (i, _), p in zip(data, plain([t for _, t in data], length)))


def passages(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdéß") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(n) for n in (12, 20, 30, 60, 200)]
    data = [(None, prose(40)), (1, None), (1, None), (2, ""), (3, shared[4]), (3, shared[4]), (4, "x" * 900), (5, "ab" * 700), (6, "x" * 99)]
    for i in range(40):
        parts = [prose(rng.randint(0, 40)) for _ in range(3)]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randrange(len(s))
            parts.insert(rng.randrange(len(parts)), s[a:a + rng.randint(50, 600)])
        data.append((100 + i, rng.choice(["", " "]).join(parts)))
    data.append((500, prose(30_000) + shared[4]))
    return data


@pytest.mark.parametrize("bucket,piece", [(4096, 1 << 20), (1, 1 << 20), (4096, 2000)])
def test_against_all_windows(spark, make_docs, monkeypatch, bucket, piece):
    """Also with every bucket refined to the end, and with texts cut into small parts."""
    monkeypatch.setattr(sr, "BUCKET", bucket)
    monkeypatch.setattr(sr, "SLICE", piece)
    data = passages(bucket + piece)
    if piece < 1 << 20:
        data = data[:-1]
    check(sr.remove_repeats(make_docs(data), length=100), data, 100)


def test_whole_table(spark, sf_tiny):
    docs = spark.read.parquet(f"{sf_tiny}/documents.parquet")
    check(sr.remove_repeats(docs, 400), [tuple(r) for r in docs.select("doc_id", "text").collect()], 400)


def test_query_counts_bytes_not_words(make_docs, spark, tmp_path):
    """Shared passages of over 50 words go from 400 bytes on, and stay below; the query's columns say so."""
    rng = random.Random(3)

    def passage(words, size, letters="abcdefgh"):
        text = " ".join("".join(rng.choice(letters) for _ in range(9)) for _ in range(words))
        while len(text.encode()) > size:  # shorten words, keep their number
            at = rng.choice([i for i in range(1, len(text)) if text[i] != " " and text[i - 1] != " "])
            text = text[:at] + text[at + 1:]
        return text

    passages = {"under": passage(60, 399), "at": passage(60, 400), "wide": passage(55, 400, "äöüß"), "one": passage(45, 449).replace(" ", "")}
    assert [len(p.split()) for p in passages.values()] == [60, 60, 55, 1]
    sizes = {k: len(p.encode()) for k, p in passages.items()}
    assert list(sizes.values()) == [399, 400, 400, 405]
    # the bytes beside a passage differ between its two places, so that nothing longer is shared
    data = [(10 * n + k, f"{k}{n} start {'AB'[k]}{p}{'CD'[k]} end {k}{n}")
            for n, p in enumerate(passages.values()) for k in (0, 1)]
    data += [(100, None), (101, "alone")]
    make_docs(data).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op7_suffix_dedup(spark, str(tmp_path)).collect()}
    want = dict(zip((i for i, _ in data), plain([t for _, t in data], 400)))
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == {
        i: (n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()) for i, (n, spans, kept) in want.items()}
    for n, (name, size) in enumerate(sizes.items()):
        assert [got[10 * n + k].n_removed for k in (0, 1)] == [size if size >= 400 else 0] * 2, name


def test_empty_table(make_docs):
    assert sr.remove_repeats(make_docs([(1, "x")]).where("false")).count() == 0


def test_identifiers_name_strings():
    data = np.frombuffer(bytes(random.Random(1).choices(b"ab", k=20_000)), np.uint8)
    for n in (1, 5, 64, 100):
        ids = sr.identifiers(data, n)
        strings = [data[i:i + n].tobytes() for i in range(len(data) - n + 1)]
        assert len(ids) == len(strings)
        assert len(set(zip(ids.tolist(), strings))) == len(set(strings)) == len(set(ids.tolist()))
