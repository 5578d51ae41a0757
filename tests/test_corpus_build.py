"""Near duplicates, document types, readers, repair and tokens, against plain Python."""

import hashlib
import io
import random
import tarfile
import zipfile

import numpy as np
import pytest

from quern.operators import doctype, neardup, passes, repair, tokens
from quern.sources import documents, manifest, sinks


def frame(spark, texts):
    return spark.createDataFrame([(i, t, f"s{i}") for i, t in enumerate(texts)], "ord long, text string, source string")


def test_signature_arithmetic_is_exact():
    hashes = np.array([0, 1, 2**63 + 12345, 2**64 - 1, neardup.PRIME, 987654321987], np.uint64)
    draw = random.Random(42)
    maps = [(draw.randrange(1, neardup.PRIME), draw.randrange(neardup.PRIME)) for _ in range(64)]
    many = np.random.default_rng(5).integers(0, 2**64, 2 * neardup.BLOCK + 3, dtype=np.uint64)
    for some in (hashes, many, many[: neardup.BLOCK]):
        assert neardup.signature(some) == [min((a * int(h) + b) % neardup.PRIME for h in some) for a, b in maps]


def test_signatures_are_those_of_the_digests(spark):
    draw = random.Random(42)
    maps = [(draw.randrange(1, neardup.PRIME), draw.randrange(neardup.PRIME)) for _ in range(64)]
    texts = ["The  Cat\nsat on\tthe mat, the cat sat on the mat", "two words", "Éclair naïve — ok fine then so", " ", None]
    got = {r.ord: list(r.sig) for r in neardup.signatures(frame(spark, texts)).collect()}
    assert sorted(got) == [0, 1, 2]
    for at, sig in got.items():
        w = texts[at].lower().split()
        shingles = {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
        hashes = [int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "big") for s in shingles]
        assert sig == [min((a * h + b) % neardup.PRIME for h in hashes) for a, b in maps]


def test_greedy_rounds_equal_the_sequence(spark):
    draw = random.Random(3)
    for _ in range(4):
        n = 14
        pairs = {(i, j) for i in range(n) for j in range(i + 1, n) if draw.random() < 0.3}
        rows = [((draw.randrange(5), draw.randrange(3), i, j), i, j, draw.choice((i, j))) for i, j in pairs]
        gone = set()
        for _, i, j, loser in sorted(rows):
            if i not in gone and j not in gone:
                gone.add(loser)
        df = spark.createDataFrame(rows, "seq struct<first:long,band:int,i:long,j:long>, i long, j long, loser long")
        got = [r.ord for r in neardup.greedy_losers(df).collect()]
        assert set(got) == gone and len(got) == len(gone)


def test_minhash_keeps_the_longer_and_spares_the_rest(spark):
    base = [f"lore{i}" for i in range(300)]
    near = " ".join(["changed", *base[1:], "a", "b", "c", "d", "e"])
    other = " ".join(f"other{i}" for i in range(300))
    got = neardup.minhash_dedup(frame(spark, [" ".join(base), near, other, "", None, other, " ".join(base)]))
    assert sorted(r.ord for r in got.collect()) == [1, 2, 3, 4]
    assert neardup.minhash_dedup(frame(spark, ["", None])).count() == 2
    assert neardup.minhash_dedup(frame(spark, [])).count() == 0


def _gone_in_order(rows, bands, threshold):
    """The sequential rule over (ord, n_chars, sig): buckets as they are opened, pairs in order."""
    buckets = {}
    for at, (_, _, sig) in enumerate(rows):
        width = len(sig) // bands
        for band in range(bands):
            buckets.setdefault((band, tuple(sig[band * width : band * width + width])), []).append(at)
    gone = set()
    for held in buckets.values():
        for x, i in enumerate(held):
            for j in held[x + 1 :]:
                if i not in gone and j not in gone and np.mean(np.array(rows[i][2]) == np.array(rows[j][2])) >= threshold:
                    gone.add(i if rows[i][1] < rows[j][1] else j)
    return gone


@pytest.mark.parametrize("seed, chunk", [(1, 1 << 20), (2, 3)])
def test_speakers_of_one_signature_change_nothing(spark, seed, chunk):
    draw = random.Random(seed)
    rows = []
    for _ in range(20):  # families apart from each other, each with signatures that repeat and interleave
        base = [draw.randrange(1 << 40) for _ in range(8)]
        forms = [[v if draw.random() < 0.7 else v + draw.randrange(1, 3) for v in base] for _ in range(4)]
        rows += [(len(rows) + k, draw.randrange(5, 12), draw.choice(forms)) for k in range(draw.randrange(3, 16))]
    want = _gone_in_order(rows, 4, 0.6)
    df = spark.createDataFrame(rows, "ord long, n_chars long, sig array<long>")
    got = [r.ord for r in neardup.near_duplicates(df, 0.6, 4, chunk).collect()]
    assert len(want) > 20 and sorted(got) == sorted(want)


def test_a_copy_outlives_the_longer_one_that_was_dropped_first(spark):
    g, y, z = [1, 1, 1, 1], [1, 1, 1, 2], [1, 3, 1, 2]
    rows = [(0, 6, g), (1, 10, y), (2, 11, z), (3, 5, g)]
    assert _gone_in_order(rows, 4, 0.75) == {0, 1}
    df = spark.createDataFrame(rows, "ord long, n_chars long, sig array<long>")
    assert {r.ord for r in neardup.near_duplicates(df, 0.75, 4).collect()} == {0, 1}


def test_keep_drop_equals_best_first_greedy(spark):
    draw, word = random.Random(8), [f"tale{i}" for i in range(400)]
    texts = [" ".join(word[s : s + draw.choice((60, 80, 100))]) for s in (draw.randrange(0, 120) for _ in range(24))]
    rec = frame(spark, texts).cache()
    pairs = {(r.a, r.b): r.overlap for r in passes.overlap_pairs(rec).collect()}
    audit = {r.ord: r for r in passes.audit(rec).collect()}
    rank = {"OK": 2, "WARN": 1, "BAD": 0}
    order = sorted(range(len(texts)), key=lambda i: (rank[audit[i].verdict], round(audit[i].wordlike_frac, 4), True, len(texts[i]), f"s{i}", -i), reverse=True)
    want, gone = {}, set()
    for k in order:
        if k not in gone:
            for x in range(len(texts)):
                if x != k and x not in gone and (min(k, x), max(k, x)) in pairs:
                    gone.add(x)
                    want[x] = k
    assert want and {r.drop: r.keep for r in neardup.keep_drop(rec).collect()} == want
    assert neardup.keep_drop(frame(spark, ["a b c d e f", "z"])).count() == 0


def test_document_types(spark):
    texts = ["Armor Class 12. Hit Points 9. Challenge 1. STR 1 DEX 2 CON 3", "If the party opens area 5, the characters find treasure", "nothing here", "hit points hit points when you", None]
    got = {r.ord: r for r in doctype.classify(frame(spark, texts)).collect()}
    assert [got[i].doc_type for i in range(5)] == ["bestiary", "adventure", None, "bestiary", None]
    assert got[0].confident and got[0].confidence == 1.0 and not got[2].confident and got[3].confidence == 0.5


def _zip(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in files.items():
            z.writestr(name, body)
    return out.getvalue()


def test_readers(spark, tmp_path):
    word = '<w:document xmlns:w="w"><w:p><w:t>one </w:t><w:t>two</w:t></w:p><w:p><w:t> </w:t></w:p><w:p><w:t>three</w:t></w:p></w:document>'
    book = {"b.xhtml": "<p>second</p>", "a b.xhtml": "<p>first</p>", "x/c.opf": '<package><manifest><item id="1" href="../a%20b.xhtml"/><item id="2" href="../b.xhtml"/></manifest><spine><itemref idref="1"/><itemref idref="2"/></spine></package>'}
    (tmp_path / "a.txt").write_bytes(b"caf\xc3\xa9 \xff")
    (tmp_path / "b.docx").write_bytes(_zip({"word/document.xml": word}))
    (tmp_path / "bad.docx").write_bytes(b"no zip")
    (tmp_path / "c.epub").write_bytes(_zip(book))
    (tmp_path / "d.html").write_text("<head><title>T</title></head><nav>menu</nav><p>a &amp; b</p><script>x</script>")
    (tmp_path / "e.zip").write_bytes(_zip({"in/x.txt": "inner", "in/y.exe": "no", "__MACOSX/z.txt": "junk", "deep.zip": _zip({"q.txt": "deep"})}))
    with tarfile.open(tmp_path / "f.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("m.md")
        info.size = 4
        t.addfile(info, io.BytesIO(b"mark"))
    (tmp_path / "g.zip").write_bytes(b"broken")
    (tmp_path / "h.bin").write_bytes(b"skip")
    got = {r.source.rsplit("/", 1)[-1] if "!" not in r.source else r.source.split("/")[-1] if "in/" not in r.source else "e.zip!in/x.txt": r.text for r in documents.read_files(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": "café �", "b.docx": "one two\n\nthree", "bad.docx": None, "c.epub": "first\n\nsecond", "d.html": "a & b", "e.zip!in/x.txt": "inner", "f.tar.gz!m.md": "mark", "g.zip": None}
    assert documents.html_text("<nav>menu</nav><p>a</p>", documents.BARE_SKIP) == "menu\na"


def test_manifest_checks():
    good = {"glob": "*.txt", "system": "d6", "doc_type": "rules", "license": "x", "publishable": True}
    assert manifest.parse([good])[0].system == "d6"
    for bad in ({**good, "system": "none"}, {**good, "more": 1}, {k: v for k, v in good.items() if k != "glob"}):
        try:
            manifest.parse([bad])
        except ValueError:
            continue
        raise AssertionError(bad)


def test_shards_hold_every_text_in_order(spark, tmp_path):
    texts = [f"document {i} " + "words and words " * 8 for i in range(40)]
    sinks.write_shards(frame(spark, [*texts, "short"]), str(tmp_path / "out"), 1000)
    shards = sorted((tmp_path / "out").glob("shard=*"), key=lambda p: int(p.name[6:]))
    assert "".join(f.read_text() for s in shards for f in s.glob("part*")) == "".join(t.strip() + "\n\n" for t in texts)


def test_repair(spark):
    assert repair.unmangle("cafÃ© ﬁne") == "café fine"
    text = "aaaa\n\n" + "b" * 25 + "\n\ncc"
    parts = repair.chunks(text, 10)
    assert "".join(parts) == text + "\n\n" and all(len(p) <= 10 for p in parts)
    assert repair.without_fence("```md\nx\n```") == "x" and repair.without_fence(" y ") == "y"
    assert repair.parse_pairs('see [1: {"a"} [{"question": "q", "answer": "a"}, {"instruction": "i"}, 3] end') == [("q", "a")]
    bad = "theGoblin Attacks forTwelve points andThe hero falls backWards again " * 5
    good = bad.replace("eG", "e G").replace("rT", "r T").replace("dT", "d T").replace("kW", "k W")
    prose = "The old keep stands above the river and its gate is barred with iron. " * 5
    rows = spark.createDataFrame([(0, bad, good), (1, bad, "other words"), (2, prose, prose), (3, bad, None), (4, None, "x")], "ord long, old string, new string")
    got = {r.ord: (r.action, r.reason) for r in repair.decisions(rows, drop_failed=True).collect()}
    assert got == {0: ("replace", "improved+faithful"), 1: ("drop", "unfaithful"), 2: ("keep", "passed"), 3: ("keep", "clean_failed"), 4: ("keep", "passed")}
    records = rows.select("ord", "old").withColumnRenamed("old", "text")
    out = {r.ord: r for r in repair.apply_decisions(repair.rewrite(records, lambda t: t.replace("eG", "e G").replace("rT", "r T").replace("dT", "d T").replace("kW", "k W")), repair.decisions(rows)).collect()}
    assert out[0].cleaned and out[0].text == good.strip() and out[2].text == prose and len(out) == 5


def test_windows_rebuild_the_stream(spark):
    rec = frame(spark, [f"text {i} " * (i % 5) for i in range(60)])
    rows = tokens.with_split(tokens.tokenised(rec)).cache()
    assert {r.split for r in rows.select("split").distinct().collect()} <= {"train", "val"}
    for split in ("train", "val"):
        want = [t for r in sorted(rows.where(f"split = '{split}'").collect()) for t in r.ids]
        got = [t for r in sorted(tokens.packed_windows(rows, 32, 8).where(f"split = '{split}'").collect(), key=lambda r: r.window) for t in r.ids]
        assert got == want
    one = tokens.with_split(tokens.tokenised(frame(spark, ["aa", "b"])), 1_000_003).collect()
    assert [r.split for r in sorted(one)] == ["train", "val"]
    assert tokens.byte_decode(tokens.byte_encode("é")) == "é"


def test_masked_examples_learn_answers_only(spark):
    turns = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", " ab "), (2, 0, "user", "alone")], "conv_id long, turn long, role string, text string")
    (row,) = tokens.masked_examples(turns).collect()
    assert len(row.ids) == len(row.targets) and [t for t in row.targets if t >= 0] == [*tokens.byte_encode("ab"), tokens.EOS]
    assert tokens.masked_examples(turns, most=5).count() == 0


def test_stitched_chats(spark):
    pairs = spark.createDataFrame([(str(i), f"u{i}", f"a{i}") for i in range(7)], "key string, user string, assistant string")
    rows = tokens.stitched_chats(pairs, 50).collect()
    chats = {}
    for r in rows:
        chats.setdefault(r.chat, []).append(r.user)
    assert len(chats) == 50 and all(2 <= len(c) <= 4 and len(set(c)) == len(c) for c in chats.values())
    assert tokens.stitched_chats(pairs.limit(1), 5).count() == 0


def test_minhash_dedup_of_documents_equals_the_sequence(spark):
    from quern.plans import catalog

    folder = "/root/testdata/sf0.001"
    draw = random.Random(42)
    maps = [(draw.randrange(1, neardup.PRIME), draw.randrange(neardup.PRIME)) for _ in range(64)]
    rows = []
    for r in sorted(catalog.records(spark, folder).collect(), key=lambda r: r.ord):
        w = (r.text or "").lower().split()
        if w:
            shingles = {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
            hashes = [int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "big") for s in shingles]
            rows.append((r.ord, len(r.text), [min((a * h + b) % neardup.PRIME for h in hashes) for a, b in maps]))
    gone = {rows[i][0] for i in _gone_in_order(rows, 16, 0.85)}
    every = {r.ord for r in catalog.records(spark, folder).select("ord").collect()}
    assert gone and {r.ord for r in catalog.minhash_dedup(spark, folder).collect()} == every - gone
