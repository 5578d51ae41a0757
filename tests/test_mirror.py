"""A local mirror of JSON books."""

import json

from quern.sources import mirror


def test_mirror_texts(spark, tmp_path):
    data = tmp_path / "data"

    def put(name, value):
        path = data / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(value if isinstance(value, str) else json.dumps(value))

    put("adventures.json", {"adventure": [{"id": "LostKeep", "name": "The Lost Keep"}, {"id": "Gone"}, {"id": "Bad"}]})
    put("adventure/adventure-lostkeep.json", {"data": [{"name": "Café", "entries": ["go {@b in}"]}]})
    (data / "adventure/adventure-bad.json").write_bytes(b'{"data": \xff\xfe}')
    put("books.json", {"book": [{"id": "R"}]})
    put("book/book-r.json", {"data": []})
    put("bestiary/index.json", {"MM": "m.json", "X": "x.json", "E": "e.json", "Q": "q.json"})
    put("bestiary/fluff-index.json", {"MM": "fluff-m.json", "Q": "fluff-none.json", "Z": "fluff-m.json"})
    put("bestiary/m.json", {"monster": [{"name": "Ogre", "size": ["L"], "type": "giant"}, {"name": "Copy", "_copy": {"name": "Ogre"}}]})
    put("bestiary/fluff-m.json", {"monsterFluff": [{"name": "Ogre", "entries": ["It is big.", " ", "It eats."]}, {"name": "Mute"}]})
    put("bestiary/x.json", {"monster": [{"name": "Imp", "size": ["T"], "type": "fiend"}]})
    put("bestiary/e.json", {"monster": []})
    put("bestiary/q.json", {"monster": [{"name": "Imp"}]})
    rows = mirror.mirror_texts(spark, str(tmp_path))
    got = {r.path: (r.text, r.failed) for r in rows.collect()}
    assert got["adventure/LostKeep.txt"][0].startswith("The Lost Keep\n\n") and "Café" in got["adventure/LostKeep.txt"][0] and got["adventure/LostKeep.txt"][0].endswith("go in\n")
    assert got["adventure/Gone.txt"] == got["adventure/Bad.txt"] == got["bestiary/Q.txt"] == (None, True)
    assert got["rules/R.txt"] == ("R\n\n\n", False)
    assert got["bestiary/MM.txt"] == ("Creatures of MM\n\nOgre\n\nL giant\n\n\nOgre\nIt is big.\nIt eats.\n", False)
    assert got["bestiary/X.txt"] == ("Creatures of X\n\nImp\n\nT fiend\n", False)
    assert len(got) == 7
    counted = mirror.mirror_counters(rows).first()
    assert (counted.files, counted.failed) == (4, 3) and counted.characters == sum(len(t) for t, _ in got.values() if t)
