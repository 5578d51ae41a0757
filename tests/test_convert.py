"""A tree of files to a tree of texts."""

import io
import os
import zipfile

from quern.sources import convert, documents

PROSE = "The old keep stands above the river and its gate is barred with iron. " * 6


def packed(**members):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for name, body in members.items():
            z.writestr(name.replace("_", "."), body)
    return held.getvalue()


def test_archives_in_archives():
    inner = packed(a_txt="one")
    outer = packed(in_zip=inner, b_txt="two", c_bin="x")
    assert {label: body for label, body in convert.expand("o.zip", outer, documents.READERS)} == {"o.zip!in.zip!a.txt": b"one", "o.zip!b.txt": b"two"}
    assert list(convert.expand("bad.zip", b"no zip", documents.READERS)) == [("bad.zip", None)]


def test_tree_is_mirrored_and_resumed(spark, tmp_path):
    src, out = tmp_path / "src", tmp_path / "out"
    (src / "sub").mkdir(parents=True)
    out.mkdir()
    (src / "a.txt").write_text(PROSE)
    (src / "sub" / "b.html").write_text(f"<p>{PROSE}</p><nav>menu</nav>")
    (src / "short.txt").write_text("short")
    (src / "x.bin").write_text("?")
    (src / "bad.zip").write_text("no zip")
    (src / "z.zip").write_bytes(packed(in_zip=packed(m_txt=PROSE)))
    run = lambda **how: convert.convert_tree(spark, str(src), str(out), **how).first().asDict()
    assert run() == {"converted": 3, "cached": 0, "rejected": 1, "skipped": 1, "archives": 2, "failed": 1}
    assert sorted(str(p.relative_to(out)) for p in out.rglob("*.txt")) == ["a.txt.txt", "sub/b.html.txt", "z.zip/in.zip/m.txt.txt"]
    assert (out / "sub" / "b.html.txt").read_text() == PROSE.strip()
    assert run() == {"converted": 0, "cached": 3, "rejected": 1, "skipped": 1, "archives": 2, "failed": 1}
    late = os.stat(out / "a.txt.txt").st_mtime + 10
    os.utime(src / "a.txt", (late, late))
    (out / "sub" / "b.html.txt").write_text("")
    assert run()["converted"] == 2
    assert run(force=True)["converted"] == 3
