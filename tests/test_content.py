"""Content rendering and the command line."""

import json

from quern import cli
from quern.functions import content


def test_tags():
    assert content.untag("{@atk mw} {@hit 5}, {@h}{@damage 1d6|x}") == "Melee Weapon Attack: +5, Hit: 1d6"
    assert content.untag("{@b see {@creature ogre|mm|the ogre}} {@dc 12} {@recharge 5} {@recharge} {@item rope|phb}") == "see the ogre DC 12 (Recharge 5-6) (Recharge 6) rope"
    assert content.untag("{@hit -2} {@unknown}") == "-2 "


def test_trees():
    tree = {"name": "Title", "entries": ["a", {"type": "image"}, {"type": "list", "items": ["x", {"entries": ["y", "z"]}]}, {"type": "quote", "entries": ["q"], "by": "me"}, 3]}
    assert content.render(tree) == "Title\n\na\n- x\n- y z\nq\n— me\n3"
    table = {"type": "table", "caption": "C", "colLabels": ["d4", "e"], "rows": [[{"roll": {"exact": 1}}, "f"], [{"roll": {"min": 2, "max": 4}}, "{@b g}"]]}
    assert content.render(table) == "C\nd4 | e\n1 | f\n2-4 | g"


def test_stat_block(spark):
    ogre = {"name": "Ogre", "size": ["L"], "type": {"type": "giant"}, "alignment": ["C", "E"], "ac": [{"ac": 11}], "hp": {"average": 59, "formula": "7d10"}, "speed": {"walk": 40, "canHover": True}, "cr": {"cr": "2"}, "action": [{"name": "Club", "entries": ["{@h}8"]}]}
    want = "Ogre\n\nL giant, C E\nArmor Class 11\nHit Points 59 (7d10)\nSpeed walk 40 ft.\nChallenge 2\n\nClub\n\nHit: 8"
    assert content.stat_block(ogre) == want
    rows = spark.createDataFrame([(json.dumps(ogre),), ("{broken",), (None,)], "raw string")
    assert [r.text for r in content.render_column(rows, "raw", creatures=True).collect()] == [want, None, None]


def test_command_line(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    prose = "The old keep stands above the river and its gate is barred with iron. " * 6
    (source / "a.txt").write_text(prose)
    (source / "b.txt").write_text(prose.upper())
    (source / "c.txt").write_text("short")
    terms = {"glob": "*.txt", "system": "d6", "doc_type": "rules", "license": "x", "publishable": True}
    (tmp_path / "m.json").write_text(json.dumps({"sources": [terms]}))
    cli.main(["ingest", str(source), str(tmp_path / "corpus"), "--manifest", str(tmp_path / "m.json")], spark)
    assert spark.read.json(str(tmp_path / "corpus")).count() == 1
    cli.main(["audit", str(tmp_path / "corpus"), str(tmp_path / "audit")], spark)
    assert [r.verdict for r in spark.read.json(str(tmp_path / "audit")).collect()] == ["OK"]
    cli.main(["classify", str(tmp_path / "corpus"), str(tmp_path / "types")], spark)
    assert spark.read.json(str(tmp_path / "types")).count() == 1
