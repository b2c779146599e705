import re
from collections import defaultdict

import corpus_pipeline as cp
from tabml.llm import simhash_bktree
from tabml.llm.queries import QUERIES, tokenizer_path


def test_names():
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_dedup", "substring_dedup", "mix_sources", "pack"]
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))


def test_stage_by_stage(spark, sf_tiny):
    docs = spark.read.parquet(f"{sf_tiny}/documents.parquet")
    columns = docs.columns
    clean = cp.language_id(spark, docs, sf_tiny)
    assert clean.columns == columns and clean.count() >= 0.99 * docs.count()
    one = cp.near_dedup(spark, clean, sf_tiny)
    assert one.columns == columns
    groups = simhash_bktree.near_duplicates(clean).collect()
    assert sorted(r.doc_id for r in one.collect()) == sorted({r.component_id for r in groups})
    cut = cp.substring_dedup(spark, one, sf_tiny)
    assert cut.columns == columns
    texts = {r.doc_id: r.text for r in one.collect()}
    for r in cut.collect():
        left = iter(texts[r.doc_id])
        assert all(c in left for c in r.text) and r.n_chars == len(r.text)  # a subsequence
    mixed = cp.mix_sources(spark, cut, sf_tiny)
    assert mixed.columns == columns
    packed = cp.pack(spark, mixed, sf_tiny).collect()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    want = sum(len(t.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed.collect())
    assert sum(r.length for r in packed) == sum(len(r.ids) for r in packed) == want
    fill = defaultdict(int)
    for r in packed:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048
    assert len(cp.run(spark, sf_tiny).collect()) > 0


def test_odd_rows(make_docs, spark):
    docs = make_docs([(1, None), (2, ""), (3, "###"), (4, "some words in a language that is said to be english"), (4, "some words in a language that is said to be english"),
                      (None, "some words in a language that is said to be english"), (5, "quite another text of words that share very little with it", "en", None),
                      (6, "long " * 30_000)]).select("doc_id", "text", "lang", "source", "n_chars")
    kept = cp.language_id(spark, docs, "")
    assert {r.doc_id for r in kept.collect()} == {4, None, 5, 6}
    one = cp.near_dedup(spark, kept, "")
    assert sorted(r.doc_id for r in one.collect()) == [4, 5, 6]
    for stage in (cp.substring_dedup, cp.mix_sources):
        one = stage(spark, one, "")
        assert one.columns == docs.columns
    assert cp.pack(spark, one, "").count() > 0


def test_empty_table(make_docs, spark):
    docs = make_docs([(1, "x")]).select("doc_id", "text", "lang", "source", "n_chars").where("false")
    for _, stage in cp.STAGES:
        out = stage(spark, docs, "")
        assert out.count() == 0
