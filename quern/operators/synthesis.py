"""Instruction data from a model, and the assembly of the whole instruction set."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import repair, tokens
from quern.session import ship

#: Texts shorter than this ground nothing; longer ones are shown to the model up to EXCERPT.
LEAST_CHARS, EXCERPT = 200, 4000

CORPUS_PROMPT = "Read the excerpt of {system} material below and write {n} questions or tasks that it answers, each clear without the excerpt, with short and true answers. Reply with a JSON array of objects with the keys instruction and response.\n\n{text}"
CREATURE_PROMPT = "Write {n} different questions about the creature described by this JSON, with answers from its fields only. Reply with a JSON array of objects with the keys question and answer.\n\n{text}"


def asked(rows: DataFrame, prompt: Column, model: Callable[[str], str], source: Column) -> DataFrame:
    """instruction, response, source: what ``model`` answers to each row's prompt.

    A call that fails, or whose answer holds no usable pair, gives no row; null prompts are
    not asked.
    """
    ship(rows.sparkSession)

    def one(text: str | None) -> list[dict]:
        if text is None:
            return []
        try:
            answer = model(text)
        except Exception:  # noqa: BLE001 - one failed generation must not end the build
            return []
        return [{"instruction": q, "response": a} for q, a in repair.parse_pairs(answer)]

    @F.pandas_udf("array<struct<instruction:string,response:string>>")
    def run(prompts):
        return prompts.map(one)

    return rows.select(source.alias("source"), F.explode(run(prompt)).alias("p")).select("p.instruction", "p.response", "source")


def _filled_in(template: str, n: int, system: Column, text: Column) -> Column:
    """The template with its places filled; braces in the text stay as they are."""
    head, tail = template.replace("{n}", str(n)).split("{text}")
    before, *after = head.split("{system}")
    return F.concat(F.lit(before), *[x for part in after for x in (system, F.lit(part))], text, F.lit(tail))


def corpus_pairs(records: DataFrame, model: Callable[[str], str], n: int = 5) -> DataFrame:
    """Pairs grounded in the beginning of each record that is long enough."""
    text = T.strip(T.filled("text"))
    prompt = _filled_in(CORPUS_PROMPT, n, F.coalesce("system", F.lit("generic")), F.substring(text, 1, EXCERPT))
    return asked(records.where(F.length(text) >= LEAST_CHARS), prompt, model, F.concat(F.lit("corpus/"), F.coalesce("source", F.lit(""))))


def creature_model_pairs(creatures: DataFrame, model: Callable[[str], str], n: int = 5) -> DataFrame:
    """Pairs about each creature (source, json) with a name that is no mere copy."""
    name, copy = F.get_json_object("json", "$.name"), F.get_json_object("json", "$._copy")
    prompt = _filled_in(CREATURE_PROMPT, n, F.lit(""), F.col("json"))
    return asked(creatures.where(name.isNotNull() & (name != "") & copy.isNull()), prompt, model, F.concat(F.lit("bestiary/"), "source"))


def assemble(parts: dict[str, DataFrame], multi_turn: int = 0, seed: int = 0) -> DataFrame:
    """origin, instruction, response, source, messages, in an order drawn by a hash.

    ``parts`` are named sets of (instruction, response, source); ``multi_turn`` conversations
    stitched from different pairs of them are added, with their turns in ``messages``.
    """
    singles = None
    for origin, pairs in parts.items():
        part = pairs.select(F.lit(origin).alias("origin"), "instruction", "response", "source")
        singles = part if singles is None else singles.unionByName(part)
    message = "array<struct<role:string,content:string>>"
    rows = singles.withColumn("messages", F.lit(None).cast(message))
    if multi_turn:
        pool = singles.select(F.sha1(F.concat_ws("\x00", "instruction", "response")).alias("key"), F.col("instruction").alias("user"), F.col("response").alias("assistant")).dropDuplicates(["key"])
        said = lambda role, col: F.struct(F.lit(role).alias("role"), F.col(col).alias("content"))
        turns = tokens.stitched_chats(pool, multi_turn, seed).select("chat", "slot", F.array(said("user", "user"), said("assistant", "assistant")).alias("m"))
        chats = turns.groupBy("chat").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("slot", "m"))), lambda x: x["m"])).cast(message).alias("messages"))
        nothing = F.lit(None).cast("string")
        rows = rows.unionByName(chats.select(F.lit("multi_turn").alias("origin"), nothing.alias("instruction"), nothing.alias("response"), nothing.alias("source"), "messages"))
    return rows.orderBy(F.xxhash64("origin", "instruction", "response", "messages", F.lit(seed)), "origin", "instruction", "response")


def counts(assembled: DataFrame) -> DataFrame:
    """origin, n."""
    return assembled.groupBy("origin").agg(F.count(F.lit(1)).alias("n"))
