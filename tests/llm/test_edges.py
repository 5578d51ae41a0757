"""Nulls in every column, empty tables, repeated rows, and extra columns with clashing names."""

import pytest
from pyspark.sql import functions as F

from quern.llm import chat_format, decontaminate, exact_dedup, html_extract, jaccard_join, langid, mixing, quality, toxicity, url_filter

EXTRA = ["_id", "_sha", "_own", "_key", "_queue", "_rank", "_chunk", "_n", "_offset", "h", "t", "n", "k1", "comp", "score", "spans", "keep_id", "kept", "copies", "Position", "slot", "label", "f", "_lang"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [(None, None, None, None, None), (None, "some words in a text here", None, None, None), (1, None, "en", "src0", 0), (2, "", "en", None, 0), (3, "one two three four five six", None, "src0", 5), (3, "one two three four five six", None, "src0", 5), (4, "One TWO three four five six", "de", "hot", 5)]


def widened(df):
    return df.withColumns({c: F.lit("x") for c in EXTRA})


@pytest.fixture(scope="module")
def tables(spark):
    labels = spark.createDataFrame([(None, None, None), (1, 1, 0), (3, 0, 1), (3, None, 1), (4, 1, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    return {
        "documents": widened(spark.createDataFrame(ROWS, DOCS)),
        "labels": labels.withColumns({"text": F.lit("x"), "count": F.lit(1)}),
        "benchmark": spark.createDataFrame([(None, None), (None, "one two three four five six"), (7, "")], "item_id long, text string").withColumns({"doc_id": F.lit(1), "spans": F.lit(1)}),
        "pages": widened(spark.createDataFrame([(None, None, None), (1, "http://a.net/", None), (1, "http://a.net/", "<p>x")], "page_id long, url string, html string")).withColumns({"text": F.lit(1), "host": F.lit(1), "rule": F.lit(1), "key": F.lit(1)}),
        "conversations": widened(spark.createDataFrame([(None, None, None, None), (1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a")], "conv_id long, turn long, role string, text string")).withColumns({"rendered": F.lit(1), "m": F.lit(1), "p1": F.lit(1)}),
    }


OPERATORS = {
    "url": (lambda t: url_filter.filter_urls(t["pages"]), 3),
    "exact": (lambda t: exact_dedup.dedup_classes(t["documents"]), 7),
    "exact rows": (lambda t: exact_dedup.dedup(t["documents"]), 4),
    "chat": (lambda t: chat_format.format_chats(t["conversations"]), 1),
    "toxicity": (lambda t: toxicity.score_toxicity(t["documents"], t["labels"]), 7),
    "html": (lambda t: html_extract.extract_pages(t["pages"]), 3),
    "leaks": (lambda t: decontaminate.find_leaks(t["documents"], t["benchmark"]), 7),
    "leaks rows": (lambda t: decontaminate.drop_leaks(t["documents"], t["benchmark"]), 4),
    "quality": (lambda t: quality.classify_quality(t["documents"], t["labels"]), 7),
    "language": (lambda t: langid.identify(t["documents"]), 7),
    "jaccard": (lambda t: jaccard_join.jaccard_components(t["documents"]), 7),
    "mix": (lambda t: mixing.mix(t["documents"]), 7),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_rows_and_clashing_columns(tables, name):
    run, n = OPERATORS[name]
    got = run(tables)
    assert len({c.lower() for c in got.columns}) == len(got.columns)
    assert got.count() == n
    assert run({k: t.limit(0) for k, t in tables.items()}).count() == 0


def test_near_copies_of_edge_rows(tables):
    kept = jaccard_join.keep_one(tables["documents"])
    assert kept.columns == tables["documents"].columns
    assert {r.doc_id for r in kept.collect()} == {None, 1, 2, 3}


def test_very_long_text(spark):
    long = "alpha beta, gamma delta. " * 120_000
    d = spark.createDataFrame([(1, long + "the gate is barred with seven iron bars", "en", "s", 1), (2, "x", "en", "s", 1)], DOCS)
    items = spark.createDataFrame([(1, "the gate is barred with seven iron bars")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.contaminated for r in decontaminate.find_leaks(d, items).collect()} == {1: True, 2: False}
    assert quality.classify_quality(d, labels).count() == toxicity.score_toxicity(d, labels).count() == langid.identify(d).count() == 2


def test_values_of_edge_rows(tables):
    """What the docstrings say of nulls, empty texts and repeated rows."""
    exact = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.dedup_classes(tables["documents"]).collect()), key=repr)
    assert exact == sorted([(None, 2, 3, False), (None, None, 1, True), (1, 2, 3, False), (2, 2, 3, True), (3, 3, 2, True), (3, 3, 2, True), (4, 4, 1, True)], key=repr)
    joined = sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in jaccard_join.jaccard_links(tables["documents"]).collect()), key=repr)
    assert joined == sorted([(None, 0, None, 0), (None, 2, None, 0), (1, 0, 1, 0), (2, 0, 2, 0), (3, 2, 3, 2), (3, 2, 3, 2), (4, 2, 3, 2)], key=repr)
    leaks = decontaminate.find_leaks(tables["documents"], tables["benchmark"]).collect()
    assert sorted((r.doc_id or 0, r.contaminated) for r in leaks) == [(0, False), (0, False), (1, False), (2, False), (3, True), (3, True), (4, True)]
    pages = sorted((r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(tables["pages"]).collect())
    assert pages == [(0, "", "", None, "allow"), (1, "a.net", "/", "net/", "block"), (1, "a.net", "/", "net/", "block")]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in html_extract.extract_pages(tables["pages"]).collect()) == [(0, "", 0), (1, "", 0), (1, "x", 1)]
    chat = chat_format.format_chats(tables["conversations"]).first()
    assert (chat.conv_id, chat.copies, chat.n_turns) == (1, 1, 3) and chat.rendered.startswith("<|unknown|>\n\n<|end|>\n<|user|>\na\n")
    spoken = {r.doc_id: r.lang_pred for r in langid.identify(tables["documents"]).collect() if r.doc_id in (1, 2)}
    assert spoken == {1: "und", 2: "und"}
    for scored in (quality.classify_quality(tables["documents"], tables["labels"]), toxicity.score_toxicity(tables["documents"], tables["labels"])):
        rows = scored.collect()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
        assert len({r.score for r in rows if r.doc_id == 3}) == 1 and len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    mixed = [r["position"] for r in mixing.mix(tables["documents"].drop("Position")).collect()]
    assert len(set(mixed)) == 7


def test_rules_that_tie_and_long_urls(spark):
    rules = {("z.org", "/x"): "block", ("org", "/x/y"): "allow", ("c.org", "/" + "p" * 5_000): "block"}
    urls = ["http://Z.org/x/y/z", "http://a.org/x/y", "http://c.org/" + "p" * 200_000, "http://c.org/" + "p" * 4_999, "://", "b.org/x", "http://xb.org/x"]
    pages = spark.createDataFrame([(None if i == 0 else i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: (r.rule and r.rule[:6], r.verdict) for r in url_filter.filter_urls(pages, rules).collect()}
    assert got == {None: ("z.org/", "block"), 1: ("org/x/", "allow"), 2: ("c.org/", "block"), 3: (None, "allow"), 4: (None, "allow"), 5: (None, "allow"), 6: (None, "allow")}
