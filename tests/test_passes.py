"""Behaviour of the corpus passes on inline inputs."""

from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import passes, sft

PROSE = "The old keep stands above the river and its gate is barred with iron. Nobody has passed it since the war began. " * 4


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "ord long, text string")


def test_exact_dedup_keeps_first(spark):
    got = passes.exact_dedup(frame(spark, ["A  b", "a b ", "c", None, ""]))
    assert sorted(r.ord for r in got.collect()) == [0, 2, 3]


def test_gate(spark):
    got = frame(spark, [PROSE, "short", "1 2 3 4 " * 60]).where(passes.is_quality(T.filled("text")))
    assert [r.ord for r in got.collect()] == [0]


def test_paragraphs_in_many_documents_go_everywhere(spark):
    legal = "This paragraph of legal words repeats across the books and says nothing at all, time after time."
    docs = [f"unique {i}\n\n{legal}" for i in range(5)] + ["other"]
    got = {r.ord: r.text for r in passes.paragraph_dedup(frame(spark, docs)).collect()}
    assert got == {**{i: f"unique {i}" for i in range(5)}, 5: "other"}
    assert passes.paragraph_dedup(frame(spark, [legal] * 5)).count() == 0


def test_audit_verdicts(spark):
    texts = [PROSE, "damageThe wizardCast fireBall atGoblin " * 6, "xkcd bcdf ghjk lmnp " * 20, "word\n" * 400, "", "a b c d e f " * 30]
    got = {r.ord: r.verdict for r in passes.audit(frame(spark, texts)).collect()}
    assert got == {0: "OK", 1: "BAD", 2: "BAD", 3: "BAD", 4: "BAD", 5: "BAD"}


def test_running_lines(spark):
    pages = spark.createDataFrame([(0, i, f"TITLE\nPage {i}\nbody {chr(97 + i)}") for i in range(6)] + [(1, i, "TITLE\nx") for i in range(2)], "ord long, page int, text string")
    got = {r.ord: r.text for r in passes.strip_running_lines(pages).collect()}
    assert got[0] == "\n".join(f"body {chr(97 + i)}" for i in range(6))
    assert got[1] == "TITLE\nx\nTITLE\nx"


def test_overlap_finds_containment_and_respects_cap(spark):
    short, long = " ".join(f"lore{i}" for i in range(300)), " ".join([f"lore{i}" for i in range(300)] + [f"extra{i}" for i in range(900)])
    rows = passes.overlap_pairs(frame(spark, [short, long])).collect()
    assert len(rows) == 1 and rows[0].overlap == 1.0 and rows[0].jaccard < 0.5
    copies = frame(spark, [short] * 4)
    assert passes.overlap_pairs(copies, max_docs=3).count() == 0
    assert passes.overlap_pairs(copies, max_docs=10).count() == 6


def test_faithfulness_sees_changed_numbers(spark):
    old = "theGoblin attacks for 12 points and the Hero falls back. " * 5
    pairs = spark.createDataFrame([(0, old, old.replace("12", "13")), (1, old, old), (2, old, "")], "ord long, old string, new string")
    assert {r.ord: r.faithful for r in passes.faithfulness(pairs).collect()} == {0: False, 1: True, 2: False}


def test_turn_pairs_drop_the_unpaired(spark):
    turns = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "user", "b"), (1, 3, "assistant", "c"), (1, 4, "assistant", "d")], "conv_id long, turn long, role string, text string")
    assert [(r.user, r.assistant) for r in sft.turn_pairs(turns).collect()] == [("b", "c")]


def test_batches_and_repairs(spark):
    got = {r.ord: (r.ids, r.targets) for r in sft.padded_batches(spark.createDataFrame([(0, [1, 2, 3]), (1, [4])], "ord long, ids array<int>"), 2).collect()}
    assert got == {0: ([1, 2, 3], [2, 3, -1]), 1: ([4, 0, 0], [-1, -1, -1])}
    one = frame(spark, ["a hyphen-\nated  \nline\n\n\n\nend\r\n"]).select(T.repair_breaks(F.col("text"))).first()[0]
    assert one == "a hyphenated\nline\n\nend"


def test_token_offsets_do_not_depend_on_chunks(spark):
    rows = frame(spark, [f"w{i} " * (i % 7) for i in range(200)])
    assert sorted(map(tuple, sft.token_offsets(rows, 16).collect())) == sorted(map(tuple, sft.token_offsets(rows, 10_000).collect()))
