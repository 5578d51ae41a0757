"""Page layout, spacing, token files, mirrored files, moves, creatures, synthesis and streams."""

import json
import random
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F

from quern.operators import creatures, layout, spacing, synthesis, tokens
from quern.sources import binfiles, moves
from quern.streaming import ingest


def words(rows):
    return pd.DataFrame([(t, float(x), float(x + 8 * len(t)), float(y), float(y + 10)) for t, x, y in rows], columns=["text", "x0", "x1", "top", "bottom"])


def test_two_columns_are_read_one_after_the_other():
    left = [(f"l{r}{c}", 20 + 30 * c, 20 * r) for r in range(8) for c in range(4)]
    right = [(f"r{r}{c}", 320 + 30 * c, 20 * r + 2) for r in range(8) for c in range(4)]
    mixed = left + right
    random.Random(1).shuffle(mixed)
    want = [" ".join(f"{s}{r}{c}" for c in range(4)) for s in "lr" for r in range(8)]
    assert layout.page_text(words(mixed), 600).split("\n") == want


def test_few_words_are_one_column():
    assert layout.page_text(words([("b", 300, 1), ("a", 0, 0), ("c", 0, 30), (" ", 0, 0)])) == "a b\nc"
    assert layout.page_text(words([])) == "" and layout.page_text(words([("one", 5, 5)])) == "one"


def test_columns_edges():
    x0 = pd.Series([0.0, 0, 0, 100, 100, 100]).to_numpy()
    # The bin that a word ends in counts as covered.
    assert layout.columns(x0, x0 + 40, 6).round().tolist() == [[0, 41], [100, 140]]
    assert layout.columns(x0, x0 + 40, 80).round().tolist() == [[0, 140]]
    many = pd.Series([40.0 * k for k in range(6) for _ in range(3)]).to_numpy()
    assert len(layout.columns(many, many + 10, 6)) == 1
    assert layout.columns(x0[:1], x0[:1], 6).tolist() == [[0, 0]]


def test_pages_of_a_table(spark):
    rows = [(1, 0, None, "b", 50.0, 60.0, 0.0, 10.0), (1, 0, None, "a", 0.0, 10.0, 0.0, 10.0), (1, 1, 600.0, "c", 0.0, 10.0, 0.0, 10.0), (2, 0, None, None, 0.0, 1.0, 0.0, 1.0)]
    frame = spark.createDataFrame(rows, "ord long, page long, width double, text string, x0 double, x1 double, top double, bottom double")
    assert sorted(tuple(r) for r in layout.read_in_order(frame).collect()) == [(1, 0, "a b"), (1, 1, "c"), (2, 0, "")]


def test_splitter_is_the_cheapest_segmentation():
    counts = Counter(random.Random(3).choices(["go", "gob", "goblin", "lin", "in", "the", "at", "attack", "tack", "s", "attacks"], k=200))
    split, total = spacing.splitter(counts), sum(counts.values()) + 1
    import math

    def cheapest(word):
        if not word:
            return 0.0
        return min((math.log(total / counts[word[:k]]) + cheapest(word[k:]) for k in range(1, len(word) + 1) if word[:k] in counts), default=math.inf)

    for word in ("thegoblinattacks", "goblingoblinattack", "attackinthegoblin"):
        assert abs(sum(math.log(total / counts[p]) for p in split(word)) - cheapest(word)) < 1e-9


def test_spacing_touches_long_lower_case_runs_only(spark):
    counts = {"the": 50, "goblin": 9, "attacks": 7, "village": 5}
    texts = ["see thegoblinattacksthevillage now", "thegoblinattacks", "Thegoblinattacksthevillage", "thegoblinattackszthevillage", None]
    got = spacing.repair_spacing(spark.createDataFrame(list(enumerate(texts)), "ord long, text string"), counts).orderBy("ord").collect()
    assert [r.text for r in got] == ["see the goblin attacks the village now", *texts[1:4], ""]
    assert spacing.vocabulary(spark.createDataFrame([("The goblin the",)], "text string")) == {"the": 2, "goblin": 1}


def test_token_files_round_trip(spark, tmp_path):
    rng = random.Random(5)
    streams = {"train": [rng.randrange(65536) for _ in range(1003)], "val": [rng.randrange(65536) for _ in range(77)]}
    rows = [(s, k // 10, ids[k : k + 10]) for s, ids in streams.items() for k in range(0, len(ids), 10)]
    rng.shuffle(rows)
    folder = tmp_path / "bins"
    binfiles.write_token_bin(spark.createDataFrame(rows, "split string, window long, ids array<int>"), str(folder), 5)
    meta = json.loads((folder / "meta.json").read_text())["splits"]
    assert {s: m["n_tokens"] for s, m in meta.items()} == {"train": 1003, "val": 77}
    for s, m in meta.items():
        data = b"".join((folder / name).read_bytes() for name, _ in m["parts"])
        assert data == b"".join(i.to_bytes(2, "little") for i in streams[s])
    assert not list(folder.glob(".*.tmp"))
    for r in binfiles.training_windows(spark, str(folder), 16).collect():
        at = r.window * 16
        assert r.x == streams[r.split][at : at + 16] and r.y == streams[r.split][at + 1 : at + 17]
    assert Counter(r.split for r in binfiles.training_windows(spark, str(folder), 16).collect()) == {"train": 62, "val": 4}
    assert binfiles.read_token_bin(spark, str(folder), 5000).count() == 0


def test_packed_windows_reach_the_files(spark, tmp_path):
    records = spark.createDataFrame([(i, f"text number {i} " * 5) for i in range(30)], "ord long, text string")
    rows = tokens.with_split(tokens.tokenised(records), 5)
    binfiles.write_token_bin(tokens.packed_windows(rows, 64), str(tmp_path / "b"), 3)
    meta = json.loads((tmp_path / "b" / "meta.json").read_text())["splits"]
    assert sum(m["n_tokens"] for m in meta.values()) == rows.agg(F.sum(F.size("ids"))).first()[0]


def test_mirror_keeps_relative_paths(spark, tmp_path):
    rows = [("a/b.pdf", "eins ä"), ("c.html", None)]
    binfiles.write_mirror(spark.createDataFrame(rows, "source string, text string"), str(tmp_path / "m"))
    assert (tmp_path / "m/a/b.pdf.txt").read_text() == "eins ä" and (tmp_path / "m/c.html.txt").read_text() == ""
    try:
        binfiles.write_mirror(spark.createDataFrame([("../x", "t")], "source string, text string"), str(tmp_path / "m"))
        raise AssertionError("a path outside was accepted")
    except Exception as error:
        assert "leads out" in str(error)
    assert not (tmp_path / "x.txt").exists()


def test_moves(spark, tmp_path):
    for name in ("a/x.txt", "b.txt", "c.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(name)
    q = tmp_path / "q"
    q.mkdir()
    (q / "b.txt").write_text("there")
    files = spark.createDataFrame([("a/x.txt",), ("b.txt",), ("gone.txt",), ("../out",), (None,)], "path string")
    state = {r.path: r.state for r in moves.quarantine(files, str(tmp_path), str(q)).collect()}
    assert state == {"a/x.txt": "moved", "b.txt": "target exists", "gone.txt": "missing", "../out": "outside", None: "outside"}
    assert (q / "a/x.txt").read_text() == "a/x.txt" and (tmp_path / "b.txt").exists() and (q / "b.txt").read_text() == "there"
    assert moves.quarantine(files.where("path = 'a/x.txt'"), str(tmp_path), str(q)).first().state == "done already"
    kinds = spark.createDataFrame([("b.txt", "rules"), ("c.txt", None)], "path string, kind string")
    assert [tuple(r)[::2] for r in moves.sort_into(kinds, str(tmp_path), str(tmp_path / "by"), F.col("kind")).collect()] == [("b.txt", "moved")]
    assert moves.delete(files.where("path like 'gone%'").unionAll(kinds.select("path").where("path = 'c.txt'")), str(tmp_path)).where("state = 'deleted'").count() == 1
    assert not (tmp_path / "c.txt").exists()


CREATURE = {"name": "Bog Rat", "size": ["S"], "type": {"type": "beast"}, "alignment": ["U"], "ac": [{"ac": 12}], "hp": {"average": 7, "formula": "2d6"}, "speed": {"walk": 30, "swim": {"number": 20}, "canHover": True}, "cr": "1/8", **dict.fromkeys(("str", "dex", "con", "int", "wis", "cha"), 9)}


def test_creature_questions(spark):
    got = creatures.questions(CREATURE)
    answers = [a for _, a in got]
    assert answers[:5] == ["The Bog Rat is a Small beast, U.", "The Bog Rat has an Armor Class of 12.", "The Bog Rat has 7 (2d6) hit points.", "The Bog Rat's speed is walk 30 ft., swim 20 ft..", "The Bog Rat has a challenge rating of 1/8."]
    assert len(got) == 7 and answers[5].endswith(" is 9.") and "Armor Class 12" in answers[6]
    assert creatures.questions({**CREATURE, "_copy": {}}) == got and creatures.questions({**CREATURE, "_copy": {"name": "x"}}) == [] and creatures.questions({}) == []
    assert [a for _, a in creatures.questions({"name": "Fog", "type": "ooze", "speed": 5})][:2] == ["The Fog is a ooze.", "The Fog's speed is 5 ft.."]
    rows = [("mm", i, json.dumps({**CREATURE, "name": f"Rat {i}"})) for i in range(3)] + [("mm", 3, "no json"), ("v", 0, json.dumps(CREATURE)), ("v", 1, None)]
    frame = spark.createDataFrame(rows, "source string, ord long, json string")
    assert Counter(r.source for r in creatures.creature_pairs(frame, 10).collect()) == {"bestiary/mm": 10, "bestiary/v": 7}
    assert creatures.creature_pairs(frame).count() == 28


def test_synthesis_and_assembly(spark):
    def model(prompt):
        if "fails" in prompt:
            raise OSError("down")
        return 'Here: [{"question": "Q ' + str(len(prompt) % 7) + '?", "answer": "A {x}"}, {"question": ""}, 3]'

    records = spark.createDataFrame([(1, "s", "a", "word {x} " * 60), (2, None, None, "fails " * 60), (3, "s", "c", "short"), (4, "s", "d", None)], "ord long, system string, source string, text string")
    made = synthesis.corpus_pairs(records, model)
    assert [(r.response, r.source) for r in made.collect()] == [("A {x}", "corpus/a")]
    beasts = spark.createDataFrame([("mm", json.dumps(CREATURE)), ("mm", '{"type": "x"}'), ("mm", "no")], "source string, json string")
    assert synthesis.creature_model_pairs(beasts, model).count() == 1
    seed = spark.createDataFrame([(f"q{i}", f"a{i}", "seed") for i in range(6)], "instruction string, response string, source string")
    whole = synthesis.assemble({"seed": seed, "corpus": made}, multi_turn=4)
    assert {r.origin: r.n for r in synthesis.counts(whole).collect()} == {"seed": 6, "corpus": 1, "multi_turn": 4}
    for r in whole.where("origin = 'multi_turn'").collect():
        asked = [m.content for m in r.messages if m.role == "user"]
        assert 2 <= len(asked) == len(set(asked)) <= 4 and [m.role for m in r.messages] == ["user", "assistant"] * len(asked)


def test_stream_admits_each_text_once_and_resumes(spark, tmp_path):
    text = "The gate of the keep has been barred with iron since the war, and nobody goes there. " * 4
    folder = tmp_path / "in"
    folder.mkdir()

    def arrive(name, rows):
        (folder / name).write_text("\n".join(json.dumps({"ord": o, "system": "s", "text": t, "arrived": "2026-01-01T00:00:00"}) for o, t in rows))

    def run():
        ingest.append(ingest.admitted(ingest.arriving(spark, str(folder))), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        return sorted(r.ord for r in spark.read.parquet(str(tmp_path / "out")).collect())

    arrive("1.jsonl", [(1, text), (2, "short"), (3, text + "More of it.")])
    assert run() == [1, 3]
    arrive("2.jsonl", [(4, text.upper()), (5, text + "Something else.")])
    assert run() == [1, 3, 5]
    fixed = spark.read.schema(ingest.SCHEMA).json(str(folder))
    got = ingest.counted(fixed).first()
    assert (got.documents, got.kept) == (5, 4)
