"""The list of sources: which files belong to the corpus, and under what terms."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.sources import documents

# The systems and the document types that a manifest may name.
SYSTEMS = (
    "dnd5e", "savage_worlds", "d6", "generic", "homebrew", "call_of_cthulhu", "dnd_magazines", "dnd_2e", "dnd_3e", "dnd_35",
    "fate", "dnd_becmi", "d20_modern", "shadowrun", "dnd_4e", "d20_variants", "add_1e", "cypher", "l5r", "warhammer_40k",
    "gurps", "starfire", "battletech", "deadlands", "exalted", "iron_kingdoms", "cyberpunk", "dcc", "world_of_darkness",
)
DOC_TYPES = ("adventure", "rules", "bestiary", "setting")


@dataclass(frozen=True)
class Source:
    glob: str
    system: str
    doc_type: str
    license: str
    publishable: bool


def parse(entries: list[dict]) -> list[Source]:
    """Checked sources; a missing or unknown key, system or type is an error."""
    names = {f.name for f in fields(Source)}
    for e in entries:
        if set(e) != names:
            raise ValueError(f"keys missing {sorted(names - set(e))}, unknown {sorted(set(e) - names)}")
        if e["system"] not in SYSTEMS or e["doc_type"] not in DOC_TYPES:
            raise ValueError(f"unknown system or type: {e['system']}, {e['doc_type']}")
    return [Source(**e) for e in entries]


def load(path: str) -> list[Source]:
    """From JSON, or from YAML where a YAML reader is installed."""
    raw = Path(path).read_text()
    if path.endswith(".json"):
        return parse(json.loads(raw)["sources"])
    import yaml

    return parse(yaml.safe_load(raw)["sources"])


def scan(spark: SparkSession, root: str, sources: list[Source]) -> DataFrame:
    """source, sha256, text, spec (place of the source in the list) and terms, of all files."""
    parts = [documents.read_files(spark, root, s.glob).select("*", F.lit(i).alias("spec"), *(F.lit(getattr(s, n)).alias(n) for n in ("system", "doc_type", "license", "publishable"))) for i, s in enumerate(sources)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
