import random
import re
import unicodedata

from tabml.llm import substring_units as su


def plain_units(text, min_words):
    """Lines, then sentences by a scan over characters."""
    out, at = [], 0
    n = len(text)
    while at < n:
        while at < n and text[at].isspace():
            at += 1
        if at == n:
            break
        end = at
        while end < n and text[end] not in "\n\r":
            stop = text[end] in ".!?" and end > at
            end += 1
            if stop and (end == n or text[end].isspace()):
                break
        unit = text[at:end]
        norm = re.sub(r"[\W_]+", " ", unicodedata.normalize("NFKC", unit).lower()).strip()
        if norm and len(norm.split(" ")) >= min_words:
            out.append((at, end, norm))
        at = end
    return out


def plain(data, min_words):
    first, out = {}, []
    keyed = sorted((i is not None, i, k) for k, (i, _) in enumerate(data))
    for _, _, k in keyed:
        for a, b, norm in plain_units(data[k][1] or "", min_words):
            first.setdefault(norm, (data[k][0], data[k][1], a))
    for i, text in data:
        gone = [(a, b) for a, b, norm in plain_units(text or "", min_words) if first[norm] != (i, text, a)]
        out.append((i, text, gone))
    return out


def check(df, data, min_words):
    got = {}
    for r in df.collect():
        got.setdefault((r.doc_id, tuple((s.start, s.end) for s in r.removed)), []).append(r)
        text = next(t for i, t in data if i == r.doc_id and (t is None) == (r.text is None))
        if r.text is not None and sum(i == r.doc_id for i, _ in data) == 1:
            assert r.text == "".join(text[s.start:s.end] for s in r.kept)
            gone = {p for s in r.removed for p in range(s.start, s.end)}
            kept = {p for s in r.kept for p in range(s.start, s.end)}
            assert not gone & kept and all(text[p].isspace() for p in set(range(len(text))) - gone - kept)
    want = {}
    for i, t, gone in plain(data, min_words):
        want.setdefault((i, tuple(gone)), []).append(t)
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in want.items()}


def test_against_a_plain_scan(make_docs):
    rng = random.Random(7)
    sentence = lambda: " ".join(rng.choice(["ab", "cd", "Ef", "ÉÈ", "gh-i", "3.14"]) for _ in range(rng.randint(1, 9))) + rng.choice([".", "!!", "?", " ", "...", "."])
    shared = [sentence() for _ in range(30)]
    data = [(-1, None), (-2, ""), (-3, " \n "), (-4, "word " * 50_000), (-5, ". . ! ?"), (-6, "no end of sentence here at all\r\nnext line of some words.Not a new one")]
    for i in range(60):
        parts = [rng.choice(shared) if rng.random() < 0.4 else sentence() for _ in range(rng.randint(0, 12))]
        data.append((i, "".join(p + rng.choice([" ", "\n", "\n\n", "  "]) for p in parts)))
    check(su.drop_repeats(make_docs(data), min_words=4), data, 4)


def test_ranks_and_repeated_rows(make_docs):
    text = "the same five word sentence. And this one is alone number"
    data = [(3, text + " a"), (1, "x the same. The SAME five-word sentence!"), (None, "other the same five word sentence"), (7, "z q. The same five word sentence."), (7, "z q. The same five word sentence.")]
    rows = {(r.doc_id, r.text) for r in su.drop_repeats(make_docs(data)).collect()}
    assert (1, "x the same. The SAME five-word sentence!") in rows  # the first of its digest
    assert (3, "And this one is alone number a") in rows
    assert (7, "z q. ") in rows


def test_whole_table(spark, sf_tiny):
    docs = spark.read.parquet(f"{sf_tiny}/documents.parquet")
    check(su.drop_repeats(docs), [tuple(r) for r in docs.select("doc_id", "text").collect()], 5)


def test_carried_columns_and_empty_table(make_docs):
    docs = make_docs([(1, "a"), (2, None)])
    rows = su.drop_repeats(docs, carry=["start", "row_hash", "lang"]).collect()
    assert {(r.start, r.row_hash, r.lang) for r in rows} == {("s", "x", "en")}
    assert su.drop_repeats(docs.where("false")).count() == 0


def test_short_whole_lines(make_docs):
    """Lines under the floor go too when they repeat; sentences under it stay."""
    data = [(1, "All rights reserved\none line of verse\nYes. It is so."), (2, "all rights  reserved.\nanother verse here\n\none line of verse!\nYes. But not so."),
            (3, "x\nAnother verse here\ny"), (4, "---\n- - -\n***"), (5, "...\n---")]
    rows = {r.doc_id: r for r in su.drop_repeats(make_docs(data), whole_lines=True).collect()}
    assert [rows[i].text for i in range(1, 6)] == [data[0][1], "another verse here\n\nYes. But not so.", "x\ny", data[3][1], data[4][1]]
    assert [(s.start, s.end) for s in rows[2].removed] == [(0, 21), (42, 60)]
    low = {r.doc_id: r.text for r in su.drop_repeats(make_docs(data)).collect()}
    assert low[2] == data[1][1]


def test_lines_and_the_sentences_in_them(make_docs):
    """A line goes as one span, though its sentences repeat as well; other lines lose their repeated sentences only."""
    one, two = "This first sentence has six words.", "And here are five more words."
    data = [(1, f"{one} {two}"), (2, f"Short. {one} {two}\nend a"), (3, f"{one} {two}\nend b"), (4, "so, THIS first sentence has six words")]
    rows = {r.doc_id: r for r in su.drop_repeats(make_docs(data), whole_lines=True).collect()}
    assert [rows[i].text for i in range(1, 5)] == [data[0][1], "Short. end a", "end b", data[3][1]]
    assert [(s.start, s.end) for s in rows[3].removed] == [(0, len(one) + 1 + len(two))]


def test_scripts_without_spaces(make_docs):
    a, b = "今日はとても良い天気ですね", "明日は雨が降るかもしれません"
    data = [(1, f"{a}。{b}。"), (2, f"前置き。{b}。以上"), (3, "ภาษาไทยไม่มีช่องว่าง"), (4, "ต้น\nภาษาไทยไม่มีช่องว่าง"), (5, "कि\nकी"), (6, "की")]
    got = {r.doc_id: r.text for r in su.drop_repeats(make_docs(data), whole_lines=True).collect()}
    assert got == {1: data[0][1], 2: "前置き。以上", 3: data[2][1], 4: "ต้น\n", 5: data[4][1], 6: ""}
    assert {r.doc_id: r.text for r in su.drop_repeats(make_docs(data)).collect()}[2] == "前置き。以上"


def test_short_lines_of_a_whole_table(spark, sf_tiny):
    """No line that an earlier row holds is left, and no row loses what no earlier one holds."""
    docs = spark.read.parquet(f"{sf_tiny}/documents.parquet")
    norm = lambda s: re.sub(r"[\W_]+", " ", unicodedata.normalize("NFKC", s).lower()).strip()
    texts = {r.doc_id: r.text for r in docs.collect()}
    n, seen, held = 0, set(), ""
    for r in sorted(su.drop_repeats(docs, whole_lines=True).collect(), key=lambda r: r.doc_id):
        for s in r.removed:
            assert norm(texts[r.doc_id][s.start:s.end]) in held + " " + norm(texts[r.doc_id][:s.start])
        gone = {(s.start, s.end) for s in r.removed}
        for m in re.finditer(r"[^\n\r]+", texts[r.doc_id]):
            line = norm(m.group())
            if line and line in seen:
                n += 1
                assert any(a <= m.start() + len(m.group()) - len(m.group().lstrip()) and m.start() + len(m.group().rstrip()) <= b for a, b in gone)
            seen.add(line)
        held += " " + norm(texts[r.doc_id])
    assert n > 0
