"""Instruction pairs about creatures, answered from the fields of their stat blocks."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import content
from quern.session import ship

# The questions, the answers and the names used in them.
SIZES = {"T": "Tiny", "S": "Small", "M": "Medium", "L": "Large", "H": "Huge", "G": "Gargantuan"}
ABILITY_NAMES = {"str": "Strength", "dex": "Dexterity", "con": "Constitution", "int": "Intelligence", "wis": "Wisdom", "cha": "Charisma"}
QUESTIONS = {
    "kind": ("What kind of creature is the {name}?", "What type of monster is a {name}?"),
    "armor": ("What is the Armor Class of the {name}?", "What's the AC of a {name}?", "How well armored is the {name}?"),
    "health": ("How many hit points does the {name} have?", "What are the hit points of a {name}?"),
    "speed": ("How fast can the {name} move?", "What is the speed of the {name}?"),
    "challenge": ("What is the challenge rating of the {name}?", "What CR is a {name}?"),
    "ability": ("What is the {name}'s {ability} score?",),
    "block": ("Give me the stat block for the {name}.",),
}
ANSWERS = {
    "kind": "The {name} is a {value}.",
    "armor": "The {name} has an Armor Class of {value}.",
    "health": "The {name} has {value} hit points.",
    "speed": "The {name}'s speed is {value}.",
    "challenge": "The {name} has a challenge rating of {value}.",
    "ability": "The {name}'s {ability} is {value}.",
    "block": "{value}",
}


def _draw(seed: int, *of: str) -> int:
    """A repeatable number: the same on every executor and at every attempt."""
    return int.from_bytes(hashlib.blake2b("\x00".join([str(seed), *of]).encode(), digest_size=8).digest(), "big")


def _kind(c: dict) -> str | None:
    """Size, type and alignment in words; nothing for a creature without a type."""
    kind, ways = content.leaf(c.get("type"), "type"), c.get("alignment")
    if isinstance(ways, list):
        ways = " ".join(filter(lambda w: isinstance(w, str), ways))
    sized = [SIZES.get(str(content.leaf(c.get("size"), "size"))), kind]
    return ", ".join(map(str, filter(None, (" ".join(map(str, filter(None, sized))), ways)))) if kind else None


def _health(c: dict) -> str | None:
    points, dice = (c["hp"].get(k) for k in ("average", "formula")) if isinstance(c.get("hp"), dict) else (None, None)
    return None if points is None else f"{points} ({dice})" if dice else f"{points}"


def _speed(c: dict) -> str | None:
    shown = None if c.get("speed") is None else content.speed(c["speed"])
    return shown and (shown if isinstance(c["speed"], dict) else f"{shown} ft.") or None


#: How each topic's value is read from a creature.
FACTS: dict[str, Callable[[dict], Any]] = {
    "kind": _kind,
    "armor": lambda c: content.leaf(c.get("ac"), "ac"),
    "health": _health,
    "speed": _speed,
    "challenge": lambda c: content.leaf(c.get("cr"), "cr"),
    "block": lambda c: content.stat_block(c) or None,
}


def questions(creature: dict, seed: int = 0) -> list[tuple[str, str]]:
    """Pairs for the fields that are there; none for a nameless creature or a mere copy."""
    name = creature.get("name")
    if not name or creature.get("_copy"):
        return []
    chosen = list(ABILITY_NAMES)[_draw(seed, str(name), "ability") % len(ABILITY_NAMES)]
    out = []
    for topic, phrasings in QUESTIONS.items():
        value = creature.get(chosen) if topic == "ability" else FACTS[topic](creature)
        if value is not None:
            words = {"name": name, "ability": ABILITY_NAMES[chosen], "value": value}
            out.append((phrasings[_draw(seed, str(name), topic) % len(phrasings)].format(**words), ANSWERS[topic].format(**words)))
    return out


def creature_pairs(creatures: DataFrame, most: int | None = None, seed: int = 0) -> DataFrame:
    """instruction, response, source from (source, ord, json): what does not parse is skipped.

    ``most`` is the number of pairs that one source may give, in the order of ``ord``.
    """
    ship(creatures.sparkSession)

    def one(raw: str | None) -> list[tuple[str, str]]:
        try:
            return questions(json.loads(raw), seed)
        except (TypeError, ValueError, AttributeError, KeyError):
            return []

    @F.pandas_udf("array<struct<instruction:string,response:string>>")
    def run(values):
        return values.map(lambda raw: [{"instruction": q, "response": a} for q, a in one(raw)])

    rows = creatures.select("source", "ord", F.posexplode(run("json")).alias("_at", "_pair"))
    if most is not None:
        rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("source").orderBy("ord", "_at"))).where(F.col("_n") <= most)
    return rows.select("_pair.instruction", "_pair.response", F.concat(F.lit("bestiary/"), "source").alias("source"))
