"""Queries that once left a part of their rows or words out, against plain Python."""

import random
import re

import numpy as np
import pytest

from quern.llm import chat_format, decontaminate, html_extract, jaccard_join, langid, queries, toxicity


@pytest.fixture
def written(spark, tmp_path):
    """Writes texts as the documents of a table folder."""

    def write(texts):
        rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
        return str(tmp_path)

    return write


def brute_links(texts):
    """n_shingles, component and number of links of each text, pair by pair."""
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    near = [[j for j in range(len(sets)) if j != i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])] for i in range(len(sets))]
    least = list(range(len(sets)))
    while (after := [min([least[i], *(least[j] for j in near[i])]) for i in range(len(sets))]) != least:
        least = after
    return [(len(s), c, len(x)) for s, c, x in zip(sets, least, near, strict=True)]


@pytest.mark.parametrize(("per_task", "spread"), [(512, 60), (6, 60), (6, 2)])
def test_jaccard_links_counts_every_link(spark, per_task, spread):
    """Chains of edits and tight groups with exact copies; per_task 6 sends them through the rounds."""
    rng = random.Random(spread)
    vocab = [f"w{i}" for i in range(400)]
    texts = [None, "", " \t ", "one", "ONE", "one two three", "one two three"]
    for _ in range(4):
        base = [rng.choice(vocab) for _ in range(70)]
        for _ in range(18):
            edited = list(base)
            for _ in range(rng.randint(0, 2)):
                edited[rng.randrange(len(edited))] = rng.choice(vocab)
            texts.append(" ".join(edited))
            if spread > 2:
                base = edited
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = brute_links(texts)
    assert max(n for _, _, n in want) >= 6
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in jaccard_join.jaccard_links(d, per_task, 2, 64, 12).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_registered_join_has_link_counts(spark, written):
    got = queries.op9_jaccard_join(spark, written(["a b c d e f", "A b c d e f", None, "g", "a b c d e f"]))
    assert [r.n_links for r in got.orderBy("doc_id").collect()] == [2, 2, 0, 0, 2]


LONG = "The gate, barred with iron, has not been opened since the war, and nobody goes there now, or so they say."


def test_html_keeps_what_stands_beside_an_inner_container():
    inner = f"<div><p>{LONG}</p><p>{LONG}</p></div>"
    beside = f"<h1>T</h1>lead<p>Short.</p>{inner}<ul><li>one</li><li>two</li></ul><section><h2>S</h2><p>End.</p></section>"
    want = ["T", "lead", "Short.", LONG, LONG, "one", "two", "S", "End."]
    menu = "<nav><a href=x>menu</a></nav>"
    links = "<div><a href=a>a link</a> <a href=b>another</a></div>"
    page = f"<html><body>{menu}{links}<div class=ad>buy this</div>%s<footer>foot</footer></body></html>"
    for kind in ("article", "main"):
        assert html_extract.extract(page % f"<{kind}>{beside}<aside>aside</aside></{kind}><p>out</p>").split("\n") == want
    assert html_extract.extract(page % f"<main><h1>M</h1><article>{beside}</article></main>").split("\n") == ["M", *want]
    assert html_extract.extract(page % f"<article>{inner}</article><article><p>Second.</p></article>").split("\n") == [LONG, LONG, "Second."]
    # Without such an element: everything up to the body but lists of links.
    assert html_extract.extract(page % f"<h1>T</h1><div><div>{beside}</div></div>").split("\n") == ["T", *want]
    # Text left out beside an article is left out there only, even where the same letters recur.
    assert html_extract.extract(page % f"x<article><h1>T</h1><div><p>{LONG}</p></div><p>x</p></article>").split("\n") == ["T", LONG, "x"]


def test_toxicity_tests_every_entry(spark):
    """More than 20,000 harmless entries are more frequent than the one that tells."""
    rng = random.Random(6)
    common = " ".join({"".join(rng.choice("bcdfghjklm") for _ in range(7)) for _ in range(6500)})
    rows = [(i, common + (" zzvileword" if i < 15 else "")) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(60)], "doc_id long, toxic int")
    lexicon = toxicity.fit_lexicon(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert set(lexicon.weights) == {" zzvileword ", " zzvi", " zzvil", " zzvile"}


def test_short_benchmark_items_are_found(spark):
    items = [(1, "One, two three"), (2, "Yes - no"), (3, "abcdefghij"), (4, "A"), (5, "yes no"), (6, None), (7, "?!")]
    texts = ["He said: yes, NO and left.", "yesno", "say one two three now", "xabcdefghijx", "a", "none", None, "", "one twothre"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.find_leaks(d, bench).collect()}
    assert [list(got[i].item_ids) for i in range(len(texts))] == [[2, 5], [], [1], [3], [4], [], [], [], []]
    assert {(s.start, s.end, s.edits) for s in got[0].spans} == {(9, 16, 0)} and [(s.start, s.end) for s in got[2].spans] == [(4, 17)]
    assert sorted(r.doc_id for r in decontaminate.drop_leaks(d, bench).collect()) == [1, 5, 6, 7, 8]


def test_tied_turns_are_ordered_by_the_whole_text(spark):
    """Tied turns that share 64 characters: of 20 such conversations, all are prefixes of longer ones."""
    rows = []
    for c in range(20):
        one, two = (f"{c} ".ljust(70, "x") + end for end in ("a", "b"))
        rows += [(2 * c, 0, "user", one), (2 * c + 1, 0, "user", one), (2 * c + 1, 0, "user", two)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_format.format_chats(turns).collect()
    assert sorted(r.conv_id for r in got) == [2 * c + 1 for c in range(20)]
    assert all(r.n_turns == 2 and r.copies == 1 for r in got)


@pytest.mark.parametrize("piece", [1 << 21, 1, 2, 3])
def test_language_counts_every_gram(monkeypatch, piece):
    monkeypatch.setattr(langid, "PIECE", piece)
    for text in ("a", "ab", "Ab c", "the gate ", " 1 x-yz!", "  ", ""):
        words = re.findall("[a-z]+", text.lower())
        line = " " + " ".join(words) + " "
        got = langid.ngram_counts(text)
        if not words:
            assert got is None
            continue
        want = np.zeros(langid.PLACES, np.int64)
        for n in (2, 3):
            for i in range(len(line) - n + 1):
                h = sum(ord(c) * k for c, k in zip(line[i : i + n], (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))) % 2**32
                h ^= 0x27D4EB2F if n == 3 else 0
                h = (h ^ h >> 15) * 0x2C1B3C6D % 2**32
                want[h >> 20] += 1
        assert got.tolist() == want.tolist()
