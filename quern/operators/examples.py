"""Instruction records of two shapes, their turns, open prompts, and the choice of a generator."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import creatures, sft, synthesis, tokens
from quern.session import ship, through_table

#: A record has instruction and response, or messages.
RECORD = "instruction string, response string, messages array<struct<role:string,content:string>>, source string"


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    """ord and the fields of ``RECORD`` of JSON lines; blank lines are none.  ``ord`` rises in the
    order of the files and their lines, and is fixed by writing it down once."""
    rows = spark.read.schema(RECORD).json(path).where("messages is not null or instruction is not null")
    return through_table(rows.withColumn("ord", F.monotonically_increasing_id()), "examples")


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """The hand-written records, of either shape, under the source ``seed``."""
    return read_examples(spark, path).withColumn("source", F.lit("seed"))


def message_pairs(messages: Column) -> Column:
    """(user, assistant) pairs of a list of messages: an answer with the user message before it,
    other roles aside; missing contents are empty."""
    talk = F.filter(messages, lambda m: m["role"].isin("user", "assistant"))
    said = lambda m: F.coalesce(m["content"], F.lit(""))
    beside = F.transform(talk, lambda m, i: F.struct(F.get(talk, i - 1).alias("q"), m.alias("a")))
    whole = F.filter(beside, lambda p: (p["a"]["role"] == "assistant") & (F.coalesce(p["q"]["role"], F.lit("")) == "user"))
    return F.transform(whole, lambda p: F.struct(said(p["q"]).alias("user"), said(p["a"]).alias("assistant")))


def with_turns(records: DataFrame) -> DataFrame:
    """``records`` with ``turns`` (user, assistant); records without any are left out."""
    single = F.array(F.struct(F.coalesce("instruction", F.lit("")).alias("user"), F.coalesce("response", F.lit("")).alias("assistant")))
    turns = F.when(F.col("messages").isNotNull(), message_pairs(F.col("messages"))).when(F.col("instruction").isNotNull(), single)
    return records.withColumn("turns", turns).where(F.size("turns") > 0)


def load_examples(spark: SparkSession, path: str, encode: tokens.Encode = tokens.byte_encode, most: int = 1024) -> DataFrame:
    """ord (as conv_id), ids, targets of a file of records, ready for training."""
    rows = with_turns(read_examples(spark, path)).select("ord", F.posexplode("turns").alias("turn", "t"))
    said = F.explode(F.array(F.struct(F.lit(0).alias("k"), F.lit("user").alias("role"), F.col("t.user").alias("text")), F.struct(F.lit(1).alias("k"), F.lit("assistant").alias("role"), F.col("t.assistant").alias("text"))))
    turns = rows.select(F.col("ord").alias("conv_id"), "turn", said.alias("m")).select("conv_id", (F.col("turn") * 2 + F.col("m.k")).cast("long").alias("turn"), "m.role", "m.text")
    return tokens.masked_examples(turns, encode, most)


def chat_prompt_ids(chats: DataFrame, encode: tokens.Encode = tokens.byte_encode) -> DataFrame:
    """ord, ids from (ord, turns, message): the finished turns in the layout of the training data,
    then the message as an open prompt."""
    ship(chats.sparkSession)

    @F.pandas_udf("array<int>")
    def run(pieces: pd.Series) -> pd.Series:
        def ids(texts) -> list[int]:
            out = [tokens.BOS]
            for k, text in enumerate(texts):
                out += encode(text) + [tokens.EOS] * (k % 2)
            return out

        return pieces.map(ids)

    done = F.flatten(F.transform(F.coalesce("turns", F.array().cast("array<struct<user:string,assistant:string>>")), lambda t: F.array(sft.prompt(t["user"]), T.strip(t["assistant"]))))
    return chats.select("ord", run(F.concat(done, F.array(sft.prompt(F.col("message"))))).alias("ids"))


def generator(kind: str, model: Callable[[str], str] | None = None, n: int = 5, most: int | None = None, seed: int = 0) -> Callable[[DataFrame], DataFrame]:
    """How creatures become pairs: ``programmatic`` (templates), ``model``, or ``both``."""
    if kind not in ("programmatic", "model", "both"):
        raise ValueError(f"unknown generator {kind!r}")
    if kind != "programmatic" and model is None:
        raise ValueError(f"generator {kind!r} needs a model")

    def run(rows: DataFrame) -> DataFrame:
        parts = [creatures.creature_pairs(rows, most, seed)] if kind != "model" else []
        parts += [synthesis.creature_model_pairs(rows, model, n)] if kind != "programmatic" else []
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    return run
