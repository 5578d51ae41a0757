"""Cached extraction, counters, records of two shapes, control tokens, RTF, reports and caps."""

import glob
import json
import zipfile

import pytest

from quern.operators import control, examples, reports, sft, tokens
from quern.sources import documents, extraction, rtf

PROSE = "The old keep stands above the river and its gate is barred with iron. " * 6


def test_rtf():
    data = rb"{\rtf1\ansi{\fonttbl{\f0 Arial;}}{\*\generator x;}\b Caf\'e9\b0  \u8212?\par one\tab two\{x\}{\pict abcd}\par\u-10179?\u-8704?}"
    assert rtf.rtf_text(data) == "Café \u2014\none\ttwo{x}\n\U0001f600"
    assert rtf.rtf_text(b"plain") is None
    assert documents.READERS[".rtf"](data).startswith("Caf")


def test_cached_extraction(spark, tmp_path):
    source, cache = tmp_path / "in", str(tmp_path / "cache")
    source.mkdir()
    (source / "a.txt").write_text("alpha")
    (source / "b.txt").write_text("alpha")
    (source / "c.bin").write_text("?")
    (source / "broken.docx").write_text("no zip")
    with zipfile.ZipFile(source / "z.zip", "w") as z:
        z.writestr("m.txt", "member")
    run = lambda where: extraction.cached_files(spark, str(source), where)
    rows, counts = run(cache)
    got = {r.source.rsplit("/", 1)[1]: (r.text, r.cached) for r in rows.collect()}
    assert got == {"a.txt": ("alpha", False), "b.txt": ("alpha", False), "broken.docx": (None, False), "z.zip!m.txt": ("member", False)}
    assert counts.first().asDict() == {"files_scanned": 4, "cache_hits": 0, "archives_expanded": 1, "skipped_unsupported": 1}
    (source / "a.txt").write_text("changed")
    rows, counts = run(cache)
    got = {r.source.rsplit("/", 1)[1]: (r.text, r.cached) for r in rows.collect()}
    assert got == {"a.txt": ("changed", False), "b.txt": ("alpha", True), "broken.docx": (None, True), "z.zip!m.txt": ("member", True)}
    assert counts.first().cache_hits == 3
    for part in glob.glob(f"{cache}/*.parquet"):
        with open(part, "wb") as f:
            f.write(b"broken")
    assert {r.source.rsplit("/", 1)[1]: r.text for r in run(cache)[0].collect()}["b.txt"] == "alpha"
    assert run(None)[1].first().cache_hits == 0


def test_build_counts(spark):
    texts = [PROSE, PROSE.upper(), "short", " ".join(f"word{i}" for i in range(80)), " ".join(f"word{i}" for i in range(81))]
    records = spark.createDataFrame([(i, "s", "d6", t) for i, t in enumerate(texts)], "ord long, source string, system string, text string")
    corpus, counts, by_system = reports.build_with_counts(records)
    assert sorted(r.ord for r in corpus.collect()) == [0, 4]
    row = counts.first()
    assert (row.dropped_low_quality, row.dropped_exact_dup, row.dropped_near_dup, row.documents) == (1, 1, 1, 2)
    assert by_system.first().documents == 2 and by_system.first().characters == row.characters


def test_repair_pass_with_cap_and_dry_run(spark):
    bad = "th3 k33p |||| #### 0000 xxq zzq " * 20
    records = spark.createDataFrame([(i, "s", t) for i, t in enumerate([bad, PROSE, bad + "x", "", None])], "ord long, source string, text string")
    out, report = reports.clean_corpus(records, lambda t: t, max_docs=1)
    assert [r.ord for r in report.collect()] == [0] and out.count() == 5
    assert reports.repair_counts(report).first().asDict() == {"targeted": 1, "replaced": 0, "kept": 1, "dropped": 0, "unfaithful": 0}
    out, report = reports.clean_corpus(records, lambda t: "", drop_failed=True)
    assert sorted(r.ord for r in out.collect()) == [1, 3, 4] and reports.repair_counts(report).first().unfaithful == 2
    assert reports.clean_corpus(records, lambda t: t, dry_run=True)[0] is None


def test_records_of_two_shapes(spark, tmp_path):
    say = lambda role, content: {"role": role, "content": content}
    lines = [
        {"instruction": "q", "response": " a "},
        {"messages": [say("system", "s"), say("user", "u1"), say("user", "u2"), say("system", "x"), say("assistant", "a2"), say("assistant", "a3"), say("user", "u4"), say("assistant", None)]},
        {"messages": [say("assistant", "a")]},
    ]
    (tmp_path / "seed.jsonl").write_text("\n\n".join(map(json.dumps, lines)) + "\n\n")
    path = str(tmp_path / "seed.jsonl")
    rows = examples.with_turns(examples.read_seed(spark, path)).orderBy("ord").collect()
    assert [[tuple(t) for t in r.turns] for r in rows] == [[("q", " a ")], [("u2", "a2"), ("u4", "")]] and rows[0].source == "seed"
    got = examples.load_examples(spark, path).orderBy("conv_id").collect()
    assert len(got) == 2
    whole = tokens.byte_decode([i for i in got[0].ids])
    assert whole.endswith("### Response:\na") and [t for t in got[0].targets if t >= 0] == tokens.byte_encode("a") + [tokens.EOS]
    chat = spark.createDataFrame([(1, [("q", " a ")], "next"), (2, None, "m")], "ord long, turns array<struct<user:string,assistant:string>>, message string")
    ids = {r.ord: r.ids for r in examples.chat_prompt_ids(chat).collect()}
    ask = lambda q: tokens.byte_encode(f"### Instruction:\n{q}\n\n### Response:\n")
    assert ids == {1: [tokens.BOS, *ask("q"), *tokens.byte_encode("a"), tokens.EOS, *ask("next")], 2: [tokens.BOS, *ask("m")]}


def test_generator_choice(spark):
    rows = spark.createDataFrame([("mm", 0, json.dumps({"name": "Ogre", "cr": "2"}))], "source string, ord long, json string")
    model = lambda prompt: '[{"question": "who?", "answer": "an ogre"}]'
    n = {kind: examples.generator(kind, model)(rows).count() for kind in ("programmatic", "model", "both")}
    assert n["model"] == 1 and n["both"] == n["programmatic"] + 1
    for bad in ("none", "model"):
        with pytest.raises(ValueError):
            examples.generator(bad)


def test_control_tokens(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    words = Tokenizer(models.WordLevel({"[UNK]": 0, "gate": 1, "iron": 2}, unk_token="[UNK]"))
    words.pre_tokenizer = pre_tokenizers.Whitespace()
    words.save(str(tmp_path / "t.json"))
    tok = control.ControlTokenizer(str(tmp_path / "t.json"))
    assert tok.vocab_size == 3 + len(control.SPECIALS) and tok.token_id("iron") == 2
    prefix = tok.control_prefix("d6", "rules")
    assert prefix == [tok.token_id(t) for t in ("<|bos|>", "<|system:d6|>", "<|doc:rules|>")]
    assert tok.encode("iron <|eos|> gate") == [2, tok.token_id("<|eos|>"), 1] and tok.decode([2, 1]) == "iron gate"
    with pytest.raises(ValueError):
        tok.control_prefix("chess", "rules")
    with pytest.raises(KeyError):
        tok.token_id("absent")
    records = spark.createDataFrame([(1, "d6", "rules", "iron gate"), (2, None, "x", None)], "ord long, system string, doc_type string, text string")
    got = {r.ord: r.ids for r in control.conditioned(records, tok).collect()}
    assert got == {1: [*prefix, 2, 1, tok.token_id("<|eos|>")], 2: [prefix[0], tok.token_id("<|eos|>")]}


def test_shard_caps_and_far_chunks(spark):
    records = spark.createDataFrame([(i * 7, "x" * 60) for i in range(200)], "ord long, text string")
    plan = sft.shard_plan(records, 600, chunk=8).orderBy("ord").collect()
    assert [(r.before, r.shard) for r in plan] == [(60 * i, 60 * i // 600) for i in range(200)]
    assert sft.shard_plan(records, 600, chunk=8, max_docs=33).count() == 33
    assert sft.shard_plan(records, 600, chunk=8, max_bytes=121).count() == 3
    totals = spark.createDataFrame([("a", i, 2) for i in range(50)] + [("b", 5, 1)], "s string, c long, n long")
    got = {(r.s, r.c): r.n_start for r in sft.running_starts(totals, ["s"], "c", ["n"], 4).collect()}
    assert got == {("a", i): 2 * i for i in range(50)} | {("b", 5): 0}
