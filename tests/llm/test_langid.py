import numpy as np
from pyspark.sql import functions as F

from tabml.llm import langid


def records(docs):
    none = F.lit(None).cast("string")
    return docs.select("doc_id", "text", F.col("lang").alias("declared"), none.alias("suffix"), none.alias("domain"), F.col("source").alias("host"), "fp")


EN = "the quick brown fox jumps over the lazy dog and then it goes home to its friends. "
DE = "der schnelle braune fuchs springt über den faulen hund und dann geht er nach hause zu den freunden. "


def model(make_docs):
    return langid.learn(make_docs([(i, EN * 3, "en", "a") for i in range(5)] + [(9 + i, DE * 3, "de", "b") for i in range(5)]), "text", "lang")


def test_counts_match_a_plain_count(make_docs):
    data = [(1, "Abc déf, abc!", "en", "a"), (2, None, "en", "a"), (3, "xyz", None, "a"), (4, "", "de", "b"), (5, "zz top", "de", "b")]
    langs, table = langid.learn(make_docs(data), "text", "lang")
    assert langs == ["de", "en"]
    counts = np.full((2, langid.BUCKETS), 0.5)
    for _, text, lang, _ in data:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        if lang and len(raw) > 2:
            folded = langid._FOLD[raw]
            for code in {code for k, code in enumerate(langid.trigrams(raw).tolist())
                         if folded[k + 1] != 32 or folded[k] != 32 and folded[k + 2] != 32}:
                counts[langs.index(lang), code] += 1
    assert np.allclose(table, np.log(counts / counts.sum(axis=1, keepdims=True)))


def test_fusion(make_docs):
    langs, table = model(make_docs)
    data = [(i, EN, "en", "hosten") for i in range(40)] + [(100 + i, DE, "de", "hostde") for i in range(40)]
    data += [(200, "the fox", "de", "hosten"), (208, "the fox", "en", "hosten"),  # text against what is declared
             (201, "", "de", "hostde"), (202, None, "en", "hosten"), (203, None, None, "hostde"),  # no text: declared and host decide
             (204, "12345 67890 #### $$$$ %%%%", None, None), (205, EN, None, None), (206, EN * 3000, "xx", "new"), (207, EN, "en", "hosten"), (207, EN, "en", "hosten")]
    out = langid.identify(records(make_docs(data)), langs, table).withColumn("accepted", langid.accepted())
    assert "fp" in out.columns and "text" not in out.columns
    rows = {}
    for r in out.collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, rows.values())) == len(data) and len(rows[207]) == 2
    for i in range(40):
        assert rows[i][0].language == "en" and rows[100 + i][0].language == "de" and rows[i][0].accepted
    assert rows[200][0].language == "en" and rows[200][0].confidence < rows[208][0].confidence
    assert rows[201][0].language == "de" and rows[202][0].language == "en" and rows[203][0].language == "de"
    for i in (201, 202, 203, 204):
        assert rows[i][0].evidence == 0 and rows[i][0].lang_text is None and not rows[i][0].accepted
    assert rows[205][0].accepted and rows[206][0].language == "en"


def plain(data, langs, table, temper=60.0, weight=20.0, trust=0.5):
    """(language, confidence, language by text) of rows (text, declared, suffix, domain, host), a language at a time."""
    n, scored = len(langs), []
    for text, *_ in data:
        [(_, _, codes, _, _)] = langid._slices(langid.pa.array([text], langid.pa.string()))
        ll = [sum(table[i][c] for c in codes) * min(len(codes), temper) / max(len(codes), 1) for i in range(n)]
        share = [np.exp(x - max(ll)) for x in ll] if len(codes) else [0.0] * n
        scored.append((ll, [x / (sum(share) or 1) for x in share], len(codes)))
    whole = [sum(p[i] for _, p, _ in scored) for i in range(n)]
    out = []
    for r, row in enumerate(data):
        ll, _, count = scored[r]

        def group(c):
            return [sum(scored[q][1][i] for q in range(len(data)) if q != r and row[c] is not None and data[q][c] == row[c]) for i in range(n)]

        prior = [(w + 1) / (sum(whole) + n) for w in whole]
        for c in (2, 3, 4):
            own = group(c)
            prior = [(own[i] + weight * prior[i]) / (sum(own) + weight) for i in range(n)]
        said = group(1)
        base = (sum(said) + 1) / (sum(whole) + 1)
        z = [ll[i] + np.log(prior[i]) + (row[1] is not None) * trust * np.log((said[i] + weight * base / 2) / (whole[i] + weight / 2)) for i in range(n)]
        best = int(np.argmax(z))
        out.append((langs[best], 1 / sum(np.exp(x - z[best]) for x in z), langs[int(np.argmax(ll))] if count else None))
    return out


def test_fusion_matches_a_plain_one(spark, make_docs):
    """All evidence at once, against sums written out; and languages by the dozen, names that clash, rows that repeat."""
    rng = np.random.default_rng(5)
    names = [f"l{i:02d}" for i in range(24)]
    words = {g: ["".join(rng.choice(list("abcdefghijklmnop"), 5)) for _ in range(30)] for g in names}
    langs, table = langid.learn(make_docs([(i, " ".join(rng.choice(words[g], 60)), g, "h") for i, g in enumerate(names * 2)]), "text", "lang")
    assert langs == names
    data = []
    for _ in range(90):
        g, h = rng.choice(names, 2)
        own = rng.choice(words[g], rng.integers(0, 4)).tolist() + rng.choice(words[h], rng.integers(0, 4)).tolist()
        data.append((" ".join(own), rng.choice([g, "xx", None]), rng.choice(["de", "fr", None]), rng.choice(["a.de", "b.fr", None]), rng.choice(["x.a.de", "y.b.fr", None])))
    data += [(None, None, None, None, None), ("", "l03", "de", "a.de", "x.a.de"), data[0], data[0]]
    rows = [(i, *(None if v is None else str(v) for v in row)) for i, row in enumerate(data)]
    records = spark.createDataFrame(rows, "i long, text string, declared string, suffix string, domain string, host string")
    clashing = records.withColumns({c: F.lit(1) for c in ("ll", "p", "p0", "z0", "host_0", "rest", "said", "of", "evidence", "gain", "language")})
    found = langid.identify(clashing, langs, table)
    assert found.columns == [c for c in clashing.columns if c not in ("text", *langid.JUDGED)] + list(langid.JUDGED)
    found = sorted(found.collect(), key=lambda r: r.i)
    assert len(found) == len(data) and all(r.ll == r.p0 == r.rest == r.of == 1 for r in found)
    for r, (language, confidence, by_text) in zip(found, plain([r[1:] for r in rows], langs, table)):
        assert (r.language, r.lang_text) == (language, by_text) and abs(r.confidence - confidence) < 1e-9


def test_rows_that_did_not_teach(spark, sf_tiny):
    """Languages learned from even ids, judged on odd ones, with nothing declared."""
    docs = spark.read.parquet(f"{sf_tiny}/documents.parquet").withColumn("fp", F.lit(1))
    langs, table = langid.learn(docs.where("doc_id % 2 = 0"), "text", "lang")
    asked = records(docs.where("doc_id % 2 = 1")).withColumn("declared", F.lit(None).cast("string"))
    judged = langid.identify(asked, langs, table).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.language == r.lang for r in judged) >= 0.95 * len(judged)


def test_own_text_is_no_evidence_for_its_host(make_docs):
    """A host's prior leaves the record itself out: alone on its host, a record gets its parents' prior."""
    langs, table = model(make_docs)
    mix = EN[:20] + DE[:20]
    base = [(i, EN, None, "h") for i in range(10)] + [(50 + i, DE, None, "g") for i in range(10)]
    one = langid.identify(records(make_docs([*base, (99, mix, None, "alone")])), langs, table).where("doc_id = 99").first()
    two = langid.identify(records(make_docs([*base, (99, mix, None, None)])), langs, table).where("doc_id = 99").first()
    assert abs(one.confidence - two.confidence) < 1e-9


def test_empty_tables(make_docs):
    docs = make_docs([(1, EN)])
    langs, table = langid.learn(docs.where("false"), "text", "lang")
    assert langs == []
    row = langid.identify(records(docs), langs, table).withColumn("accepted", langid.accepted()).first()
    assert row.language is None and not row.accepted
    langs, table = model(make_docs)
    assert langid.identify(records(docs.where("false")), langs, table).count() == 0


def test_address_parts(spark):
    urls = {"https://Blog.Example.co.DE:80/x?y": ("blog.example.co.de", "co.de", "de"), "http://user@host/": ("host", "host", None),
            "//a.b.c#d": ("a.b.c", "b.c", "c"), "no url": (None, None, None), "": (None, None, None), None: (None, None, None)}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    host, domain, suffix = langid.host_parts(F.col("url"))
    for r in df.select("url", host.alias("h"), domain.alias("d"), suffix.alias("s")).collect():
        assert (r.h, r.d, r.s) == urls[r.url], r
    pages = spark.createDataFrame([("<!doctype html><HTML class=x LANG='de-AT'>",), ("<html lang=fr>",), ("<html>",), (None,)], "html string")
    assert [r[0] for r in pages.select(langid.declared_language(F.col("html"))).collect()] == ["de", "fr", None, None]


def test_whole_table(spark, sf_tiny):
    docs = spark.read.parquet(f"{sf_tiny}/documents.parquet")
    langs, table = langid.learn(docs, "text", "lang")
    rows = langid.identify(records(docs.withColumn("fp", F.lit(1))), langs, table).withColumn("accepted", langid.accepted()).collect()
    assert len(rows) == docs.count()
    assert sum(r.accepted for r in rows) >= 0.99 * len(rows)
    assert sum(r.language == r.declared for r in rows) >= 0.97 * len(rows)
