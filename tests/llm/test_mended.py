"""Odd, repeated and very long rows: each case has the result that the docstrings define."""

import random
import resource

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import decontaminate, exact_dedup, html_extract, langid, mixing, quality, toxicity
from quern.llm.common import labelled_docs

LONG = "The gate, barred with iron, has not been opened since the war, and nobody goes there now, or so they say."


# ---------------------------------------------------------------- op5


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<![foo[bar]]><p>x", "x"),
        ("<p>a<!-- open", "a"),
        ("<p>a<![CDATA[x > y]]>b", "ab"),
        ("<p>t<a href='x", "t"),
        ("<p>t</p></", "t"),
        ("<p>a</p><?php x", "a"),
        ("<!x><!DOCTYPE", ""),
        (f"<article><h2 class='section-header'>S</h2><p class='share-price'>P {LONG}</p></article>", f"S\nP {LONG}"),
        (f"<article><div class='article-header'><h1>T</h1></div><p>{LONG}</p></article>", f"T\n{LONG}"),
        (f"<div class='with-sidebar'><p>{LONG}</p></div><div class='left-sidebar'><p>{LONG}</p></div>", LONG),
        (f"<article><p>{LONG}</p><p class='cookie-notice'>{LONG}</p><div class='ad-slot'>{LONG}</div></article>", LONG),
        (f"<article><p>{LONG}</p><h3 class='comments'>Comments</h3><ul id='comments-list'><li>{LONG}</li></ul></article>", LONG),
        (f"<article><p>{LONG}</p><div style='display: none'>{LONG}</div><div hidden>x</div></article>", LONG),
        (f"<main><header><h1>T</h1></header><p>{LONG}</p><footer>f</footer></main><header>site</header>", f"T\n{LONG}"),
        (f"<article>before<div><p>{LONG}</p></div>after<ul><li>one</ul></article>", f"before\n{LONG}\nafter\none"),
        (f"<div role='navigation'><p>{LONG}</p></div><section role='region'><p>{LONG}</p></section>", LONG),
        (f"<table><tr><td>{LONG}<td>two</table>", f"{LONG}\ntwo"),
        ("<p>a&nbsp;&#x62;\n\t c &lt;d&gt; &amp;amp;</p>", "a b c <d> &amp;"),
        ("<nav><a href=x>menu</a></nav>", ""),
        (f"<div><p>{LONG}</p></div><div><p>{LONG}</p></div>", f"{LONG}\n{LONG}"),
    ],
)
def test_pages(html, want):
    assert html_extract.extract(html) == want


def test_odd_page_does_not_end_the_job(spark):
    pages = spark.createDataFrame([(1, "u", "<![foo[bar]]><p>x"), (2, "u", "<p>y")], "page_id long, url string, html string")
    assert [r.text for r in html_extract.extract_pages(pages).orderBy("page_id").collect()] == ["x", "y"]


def test_tree_sums_equal_plain_ones():
    """Every element measured by itself, every paragraph's points walked up to each ancestor."""
    rng = random.Random(3)
    tags = ["div", "p", "li", "a", "b", "section", "article", "nav", "td"]
    for _ in range(60):
        html = "".join(rng.choice([f"<{rng.choice(tags)}>", f"</{rng.choice(tags)}>", "some words, and more ", "x, "]) for _ in range(60))
        tree = html_extract.Tree()
        tree.read(html)

        def below(node):
            return [x for c in node.children if isinstance(c, html_extract.Node) and not c.dropped for x in (c, *below(c))]

        def measure(node, link=False):
            link, out = link or node.tag == "a", np.zeros(3, int)
            for c in node.children:
                if isinstance(c, str):
                    n = len(" ".join(c.split()))
                    out += (n, c.count(","), n * link)
                elif not c.dropped:
                    out += measure(c, link)
            return out

        want = dict.fromkeys(map(id, below(tree.root)), 0.0)
        for node in below(tree.root):
            chars, commas, linked = measure(node)
            if node.tag in html_extract.PARAGRAPH and chars and not any(x.tag in html_extract.PARAGRAPH for x in below(node)):
                points, up = (1 + commas + min(chars / 100, 3)) * (1 - linked / chars), node.parent
                while up is not tree.root:
                    want[id(up)] += points
                    points, up = points / 2, up.parent
        html_extract.score_tree(tree.root)
        for node in below(tree.root):
            assert (node.chars, node.commas, node.linked) == tuple(measure(node))
            assert node.score == pytest.approx(want[id(node)])


def test_deep_pages_take_seconds():
    for opening in ("<div>", "<p><div>", "<b>", "<header>", "<ul><li>"):
        assert html_extract.extract(opening * 50_000 + f"<p>{LONG}</p>" + "</div>" * 50_000).endswith(LONG) or opening == "<header>"


# ---------------------------------------------------------------- op6


def test_repetitive_text_stays_small():
    index = decontaminate.Index([(1, "7" * 300), (2, "7" * 290 + "abcdefghij"), (3, "8" * 300)])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    found = index.find("x " + "7" * 300_000 + " y")
    assert found == [(1, 2, 302, 0), (2, 2, 292, 10)]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500 << 10


def test_blocks_of_hits_do_not_change_what_is_found(monkeypatch):
    rng = random.Random(8)
    items = ["".join(rng.choice("ab") for _ in range(60)) for _ in range(4)]
    index = decontaminate.Index(list(enumerate(items)))
    texts = ["".join(rng.choice("ab") for _ in range(200)) + i[:30] + rng.choice(["", "b", "aa"]) + i[30:] for i in items for _ in range(5)]
    whole = [index.find(t) for t in texts]
    assert any(whole)
    monkeypatch.setattr(decontaminate, "OPEN_HITS", 7)
    monkeypatch.setattr(decontaminate, "OPEN_CELLS", 1)
    assert [index.find(t) for t in texts] == whole


def test_benchmark_in_slices(spark):
    items = spark.createDataFrame([(i, f"item number {i} speaks of {w} and iron gates") for i, w in enumerate(["rivers", "towers", "horses"])], "item_id long, text string")
    d = spark.createDataFrame([(i, f"Item number {i} speaks of {w}, and iron gates!") for i, w in enumerate(["rivers", "towers", "horses", "ships"])], "doc_id long, text string")
    for limit in (10, 1000):
        got = {r.doc_id: list(r.item_ids) for r in decontaminate.find_leaks(d, items, limit).collect()}
        assert got[0] == [0] and got[1] == [1] and got[2] == [2]
        assert [r.doc_id for r in decontaminate.drop_leaks(d, items, limit).collect()] == [i for i in range(4) if not got[i]]


# ---------------------------------------------------------------- op7, op8, op4: the fits


@pytest.mark.parametrize("copies", [1, 2, 5])
def test_quality_fits_the_smallest_classes(spark, copies):
    rows = [(i, "plain words in a row here" if i % 2 else "#### |||| $$$$ 0000") for i in range(2 * copies)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(2 * copies)], "doc_id long, quality int")
    model = quality.fit_quality(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert (model.judge([rows[1][1], rows[0][1], None]) >= 0.5).tolist()[:2] == [True, False]


def test_quality_scores_are_log_density_differences():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(60, 3)) + np.arange(60)[:, None] % 2, np.arange(60) % 2
    model = quality.Discriminant.fit(x, y)
    for v in x[:8]:
        z, log = (v - model.shift) / model.scale, []
        for mean, factor, _, prior in model.parts:
            cov = factor @ factor.T
            log.append(-0.5 * ((z - mean) @ np.linalg.inv(cov) @ (z - mean) + np.log(np.linalg.det(cov))) + prior)
        assert model.scores(v[None])[0] == pytest.approx(1 / (1 + np.exp(log[0] - log[1])))


def test_samples_are_bounded_whatever_the_table_holds(spark):
    """One id on a third of the rows, ten thousand languages, labels beside 0 and 1."""
    d = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.concat(F.lit("l"), F.col("id") % 10_000).alias("lang"))
    d = d.unionByName(spark.range(5000).select((F.col("id") + 90_000).alias("doc_id"), F.lit("hot text").alias("text"), F.lit("hot").alias("lang")))
    sample = langid.language_sample(d, None, 240).collect()
    assert len(sample) <= 240 and sum(r._lang == "hot" for r in sample) == 8
    labels = spark.range(0, 30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 5 == 0, 7).otherwise(F.col("id") % 2).cast("int").alias("quality"))
    picked = labelled_docs(d, labels, "quality", F.lit(True), 50).collect()
    assert len(picked) <= 100 and {r.quality for r in picked} == {0, 1} and len({r.doc_id for r in picked}) == len(picked)


def test_language_counts_of_long_texts_are_whole():
    counts = langid.ngram_counts("ab " * 200_000)
    assert counts.max() == 200_000 and (langid.unpack_counts(langid.pack_counts(counts)) == counts).all()


def test_equal_cosines_go_to_the_first_language(spark):
    d = spark.createDataFrame([(i, "the river and the gate", lang) for i, lang in enumerate(["zz", "aa", "zz", "aa", "zz", "aa"])], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.identify(d).collect()} == {"aa"}


def plain_measure(lexicon, text):
    words = toxicity.fold_text(text).split()
    total, seen = 0.0, 0
    for i, w in enumerate(words):
        hits = [lexicon.weights[f] for f in toxicity.word_features(w) if f in lexicon.weights]
        around = {(words[i - 1] if i else "", w), (w, words[i + 1] if i + 1 < len(words) else "")}
        if hits and not around & lexicon.exceptions:
            total += max(hits)
            seen += 1
    return total / toxicity.length_norm(toxicity.fold_text(text).count(" "))


def test_toxicity_measure_equals_word_by_word(monkeypatch):
    lexicon = toxicity.Lexicon({" vile ": 3.0, " vill": 1.0, " stin": 2.0, " idiot ": 4.0}, frozenset([("not", "vile"), ("idiot", "proof"), ("", "stink")]))
    rng = random.Random(5)
    words = ["v1le", "VILE", "villa", "st!nk", "idi0t", "proof", "not", "plain", "a", ",", "...", "x" * 90, "vіle", "stinking"]
    for _ in range(200):
        text = " ".join(rng.choice(words) + rng.choice(["", ",", "  ", "-"]) for _ in range(rng.randint(0, 30)))
        assert lexicon.measure(text) == pytest.approx(plain_measure(lexicon, text))
    text = " ".join(rng.choice(words) for _ in range(400))
    whole = lexicon.measure(text)
    monkeypatch.setattr(toxicity, "PIECE", 7)
    assert lexicon.measure(text) == pytest.approx(whole)


# ---------------------------------------------------------------- op2, op10


def test_exact_rows_of_repeated_ids(spark):
    rows = [(3, "a", "x"), (3, "a", "y"), (3, "b", "x"), (1, "a", "x"), (None, "c", "x"), (None, None, "x"), (2, "", "x"), (9, "L" * 300_000, "x"), (8, "L" * 300_000, "x")]
    d = spark.createDataFrame(rows, "doc_id long, text string, kept_row string")
    for keep, want in (("largest", {(3, "a"), (3, "b"), (None, "c"), (2, ""), (9, "L")}), ("smallest", {(1, "a"), (3, "b"), (None, "c"), (2, ""), (8, "L")})):
        kept = exact_dedup.dedup(d, keep)
        assert kept.columns == d.columns
        assert sorted(((r.doc_id, (r.text or "")[:1]) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_mix_of_repeated_ids_is_repeatable(spark):
    rows = [(7 if i % 2 else None, f"text {i}", "hot") for i in range(200)]
    one = spark.createDataFrame(rows, "doc_id long, text string, source string")
    two = spark.createDataFrame(rows[::-1], "doc_id long, text string, source string").repartition(5)
    place = lambda d: {r.text: r.position for r in mixing.mix(d, chunk_rows=16).collect()}
    assert place(one) == place(two) and len(set(place(one).values())) == 200
