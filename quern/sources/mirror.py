"""Texts of a local mirror of JSON books: adventures, rule books, and creatures with their lore.

The index files are small tables; the files they name are joined to them by name, so one scan
reads the mirror, and what an index names but the mirror lacks, or what does not parse, becomes a
row that says so instead of the end of the job.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import content
from quern.session import ship

# For each kind of book the index file, the list in it, and the folder of its texts.
BOOKS = {"adventure": ("adventures.json", "adventure", "adventure"), "book": ("books.json", "book", "rules")}
CREATURES, LORE, CREATURE_FOLDER = "bestiary/index.json", "bestiary/fluff-index.json", "bestiary"


def book_body(raw: str) -> str:
    return content.render(json.loads(raw).get("data", []))


def creature_body(raw: str, lore: str | None) -> str:
    """Stat blocks of all creatures that are no mere copies, then the lore under its names."""
    blocks = [content.stat_block(c) for c in json.loads(raw).get("monster", []) if not c.get("_copy")]
    for told in json.loads(lore).get("monsterFluff", []) if lore is not None else ():
        said = "\n".join(filter(str.strip, content.lines(told.get("entries", []))))
        blocks.append(said and f"\n{told.get('name', '')}\n{said}")
    return "\n\n".join(filter(None, blocks))


def _quiet(body, *raws: str | None) -> str | None:
    """What ``body`` makes of the files; null where there is none or it cannot be read."""
    try:
        return body(*raws)
    except (TypeError, ValueError, AttributeError, KeyError):
        return None


def _files(spark: SparkSession, root: str) -> DataFrame:
    """file (its path below ``data``), raw."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(f"{root.rstrip('/')}/data")
    return found.select(F.regexp_extract("path", r"/data/((?:[^/]+/)?[^/]+)$", 1).alias("file"), F.make_valid_utf8(F.col("content").cast("string")).alias("raw"))


def _books(files: DataFrame, kind: str) -> DataFrame:
    index, key, folder = BOOKS[kind]

    @F.pandas_udf("string")
    def body(raw: pd.Series) -> pd.Series:
        return raw.map(lambda r: _quiet(book_body, r))

    parsed = files.where(F.col("file") == index).select(F.from_json("raw", f"{key} array<struct<id:string,name:string>>").alias("index"))
    named = parsed.select(F.explode(F.col("index")[key]).alias("b")).select("b.id", F.coalesce("b.name", "b.id").alias("title"))
    wanted = named.withColumn("file", F.concat(F.lit(f"{kind}/{kind}-"), F.lower("id"), F.lit(".json")))
    return wanted.join(files, "file", "left").select(F.concat(F.lit(f"{folder}/"), "id", F.lit(".txt")).alias("path"), "title", body("raw").alias("body"))


def _creatures(files: DataFrame) -> DataFrame:
    """A source's creatures, left outer joined with its lore."""

    @F.pandas_udf("string")
    def body(raw: pd.Series, lore: pd.Series) -> pd.Series:
        return pd.Series([_quiet(creature_body, r, x) for r, x in zip(raw, lore)], dtype=object)

    def indexed(index: str, name: str) -> DataFrame:
        parsed = files.where(F.col("file") == index).select(F.explode(F.from_json("raw", "map<string,string>")).alias("source", "file"))
        return parsed.withColumn("file", F.concat(F.lit("bestiary/"), "file")).join(files, "file", "left").select("source", F.col("raw").alias(name), F.lit(True).alias(f"has_{name}"))

    both = indexed(CREATURES, "raw").join(indexed(LORE, "lore"), "source", "left")
    lost = F.col("has_lore") & F.col("lore").isNull()
    text = F.when(~F.coalesce(lost, F.lit(False)), body("raw", "lore"))
    rows = both.select(F.concat(F.lit(f"{CREATURE_FOLDER}/"), "source", F.lit(".txt")).alias("path"), F.concat(F.lit("Creatures of "), "source").alias("title"), text.alias("body"))
    return rows.where("body is null or body <> ''")


def mirror_texts(spark: SparkSession, root: str, kinds: tuple[str, ...] = ("adventure", "book", "creatures")) -> DataFrame:
    """path, text, failed: one row per book that the indexes under ``root`` name.

    Sources without a word about any creature have no row; ``text`` is null where ``failed``.
    ``binfiles.write_mirror`` writes the others as files.
    """
    ship(spark)
    files, found = _files(spark, root), None
    for kind in kinds:
        rows = _creatures(files) if kind == "creatures" else _books(files, kind)
        found = rows if found is None else found.unionByName(rows)
    return found.select("path", F.when(F.col("body").isNotNull(), F.concat("title", F.lit("\n\n"), "body", F.lit("\n"))).alias("text"), F.col("body").isNull().alias("failed"))


def mirror_counters(texts: DataFrame) -> DataFrame:
    """files, characters, failed."""
    return texts.agg(F.count("text").alias("files"), F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("long").alias("characters"), F.count(F.when(F.col("failed"), 1)).alias("failed"))
