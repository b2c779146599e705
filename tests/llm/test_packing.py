import random

import numpy as np
import pytest

from tabml.llm import packing
from tabml.llm.packing import LevelPacker
from tabml.llm.queries import tokenizer_path
from tabml.llm.wordbpe import WordBpe


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def check(rows, docs, tokenizer, window):
    """Every document's ids, in pieces without gaps, in gapless sequences; returns the padding."""
    want = sorted(([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for _, t in docs))
    by_doc, by_seq = {}, {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append(r)
    got = []
    spare = {}
    for r in rows:
        spare.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for pieces in spare.values():
        pieces.sort(key=lambda r: (r.start, r.sequence_id))
        n = pieces[0].doc_tokens
        while pieces:  # repeated rows: chain pieces to whole documents
            at, ids = 0, []
            while at < n:
                i = next(i for i, p in enumerate(pieces) if p.start == at)
                p = pieces.pop(i)
                assert p.length > 0
                ids += np.frombuffer(bytes(p.ids), "<u4").tolist()
                at += p.length
            assert at == n == len(ids)
            got.append(ids)
    assert sorted(got) == want
    padding = 0
    for pieces in by_seq.values():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for p in pieces:
            assert p.offset == at
            at += p.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_ids_equal_the_tokenizers(tokenizer):
    import pyarrow as pa

    texts = ["", None, "Hello, World! it's ÀÉß 3.14 ½ ² x́ ﬁ", "a\x1cb c d", "<|endoftext|> <|start", "ΑΣ ΣΑΣ İi 漢字 😀!!", "won't DON'T 'tis",
             "\x0b\x0c tabs\t\tand\r\nlines  ", "x" * 5000, "word### A&&& $$$ [x]_y `z{|}~"]
    for text, ids in zip(texts, WordBpe(tokenizer_path()).encode(pa.array(texts))):
        assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, text


def test_pack_whole_table(spark, sf_tiny, tokenizer):
    docs = spark.read.parquet(f"{sf_tiny}/documents.parquet")
    rows = packing.pack(docs, tokenizer_path(), window=256).collect()
    assert check(rows, [tuple(r) for r in docs.select("doc_id", "text").collect()], tokenizer, 256) == 0


def test_odd_rows(make_docs, tokenizer):
    data = [(1, None), (1, None), (None, "null id"), (2, ""), (3, "same"), (3, "same"), (4, "long " * 3000), (5, " \n\t ")]
    rows = packing.pack(make_docs(data), tokenizer_path(), window=64).collect()
    assert check(rows, data, tokenizer, 64) == 0
    listed = packing.pack(make_docs(data), tokenizer_path(), window=64, as_list=True).collect()
    assert sorted(list(r.ids) for r in listed) == sorted(np.frombuffer(bytes(r.ids), "<u4").tolist() for r in rows)


def test_empty_table(make_docs):
    assert packing.pack(make_docs([(1, "x")]).where("false"), tokenizer_path()).count() == 0


def test_level_rule_is_the_least_sum_of_squares():
    rng = random.Random(3)
    packer = LevelPacker(40, lambda pieces: None)
    for i in range(400):
        size = rng.randint(1, 39)
        counts = packer.count.copy()

        def after(level):
            n = counts.copy()
            if level:
                n[level] -= 1
            if level + size < 40:
                n[level + size] += 1
            return int((n[1:40] ** 2).sum())

        chosen = packer.choose(size)
        options = [h for h in range(0, 40 - size + 1) if h == 0 or counts[h]]
        assert after(chosen) == min(map(after, options))
        packer.add(i, np.zeros(size, np.uint32))


def test_open_windows_are_bounded():
    """Documents of which no two fit together would stay open for ever."""
    closed = []
    packer = LevelPacker(100, closed.append, max_open=16)
    for i in range(500):
        packer.add(i, np.full(60, i, np.uint32))
        assert packer.n_open <= 17
    packer.drain(last=True)
    assert sum(len(p[2]) for w in closed for p in w) == 500 * 60
    assert sum(sum(len(p[2]) for p in w) == 100 for w in closed) == 300
