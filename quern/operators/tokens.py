"""Token passes: encoding, documents framed by control tokens, packed windows, masked examples."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import sft
from quern.session import ship, small_batches, through_table

Encode = Callable[[str], list[int]]
# Ids that the byte encoder keeps free for control tokens.
PAD, BOS, EOS, BYTES_FROM = 0, 1, 2, 3


def byte_encode(text: str) -> list[int]:
    """UTF-8 bytes above the control tokens: an encoder that needs no vocabulary."""
    return [b + BYTES_FROM for b in text.encode("utf-8")]


def byte_decode(ids: list[int]) -> str:
    return bytes(i - BYTES_FROM for i in ids if i >= BYTES_FROM).decode("utf-8", "replace")


def file_encoder(path: str) -> Encode:
    """An encoder of a ``tokenizer.json``; the file must be readable on every executor."""
    held: list = []

    def encode(text: str) -> list[int]:
        if not held:
            from tokenizers import Tokenizer

            held.append(Tokenizer.from_file(path))
        return held[0].encode(text, add_special_tokens=False).ids

    return encode


def tokenised(records: DataFrame, encode: Encode = byte_encode, prefix: tuple[int, ...] = (BOS,), eos: int = EOS) -> DataFrame:
    """ord, id, ids: prefix, tokens and end of each record.  ``id`` is the sha1 of the text."""
    ship(records.sparkSession)
    small_batches(records.sparkSession)
    front = list(prefix)

    @F.pandas_udf("array<int>")
    def run(t: pd.Series) -> pd.Series:
        return t.map(lambda x: front + encode(x) + [eos])

    return records.select("ord", F.sha1(T.filled("text")).alias("id"), run(T.filled("text")).alias("ids"))


def with_split(rows: DataFrame, modulus: int = 50) -> DataFrame:
    """``rows`` (ord, id, ids) with ``split``; if no record falls into validation and there is
    more than one, the smallest (by tokens, then id) is promoted."""
    chosen = rows.withColumn("val", sft.in_validation(F.col("id"), modulus))
    state = chosen.agg(F.count(F.when(F.col("val"), 1)).alias("n"), F.countDistinct("id").alias("all"), F.min_by("id", F.struct(F.size("ids"), "id")).alias("least")).first()
    if state["n"] == 0 and state["all"] > 1:
        chosen = chosen.withColumn("val", F.col("id") == state["least"])
    return chosen.withColumn("split", F.when(F.col("val"), "val").otherwise("train")).drop("val")


def packed_windows(rows: DataFrame, length: int, chunk: int = 1024) -> DataFrame:
    """split, window, ids: each split's token stream in windows of ``length``, the last shorter.

    A record is cut where windows end, so a group holds at most ``length`` tokens.  Places follow
    from the numbers of tokens alone, which go through a table: records are encoded once for these
    and once to be cut, in one stage at a time.
    """
    sized = rows.select("ord", "split", F.size("ids").cast("long").alias("n"), F.floor(F.col("ord") / chunk).alias("chunk"))
    counted = through_table(sized).where("n > 0")
    totals = counted.groupBy("split", "chunk").agg(F.sum("n").alias("t"))
    starts = sft.running_starts(totals, ["split"], "chunk", ["t"]).withColumnRenamed("t_start", "start")
    local = F.coalesce(F.sum("n").over(Window.partitionBy("split", "chunk").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counted.withColumn("local", local).join(starts, ["split", "chunk"]).select("ord", "split", "n", (F.col("start") + F.col("local")).alias("at"))
    placed = rows.select("ord", "ids").join(offsets, "ord")
    cut = placed.select("split", "at", "n", "ids", F.explode(F.sequence(F.floor(F.col("at") / length), F.floor((F.col("at") + F.col("n") - 1) / length))).alias("window"))
    begin = F.greatest(F.col("window") * length, F.col("at"))
    end = F.least((F.col("window") + 1) * length, F.col("at") + F.col("n"))
    parts = cut.select("split", "window", begin.alias("at"), F.slice("ids", (begin - F.col("at") + 1).cast("int"), (end - begin).cast("int")).alias("ids"))
    joined = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "ids"))), lambda p: p["ids"]))
    return parts.groupBy("split", "window").agg(joined.alias("ids"))


def masked_examples(turns: DataFrame, encode: Encode = byte_encode, most: int = 1024) -> DataFrame:
    """conv_id, ids, targets: conversations framed turn by turn, -1 wherever the next token is not
    part of an answer; conversations of which no answer survives the length limit are left out."""
    ship(turns.sparkSession)
    small_batches(turns.sparkSession)

    @F.pandas_udf("array<int>")
    def run(t: pd.Series) -> pd.Series:
        return t.map(encode)

    pairs = sft.turn_pairs(turns).select("conv_id", "turn", run(sft.prompt(F.col("user"))).alias("q"), F.concat(run(T.strip(F.col("assistant"))), F.array(F.lit(EOS))).alias("a"))
    token = lambda ids, flag: F.transform(ids, lambda i: F.struct(i.alias("id"), F.lit(flag).alias("t")))
    turn = pairs.select("conv_id", "turn", F.concat(token(F.col("q"), False), token(F.col("a"), True)).alias("tokens"))
    all_ = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("turn", "tokens"))), lambda p: p["tokens"]))
    first = F.array(F.struct(F.lit(BOS).alias("id"), F.lit(False).alias("t")))
    rows = turn.groupBy("conv_id").agg(F.slice(F.concat(first, all_), 1, most).alias("f")).where("size(f) >= 2 and exists(f, x -> x.t)")
    ids = F.transform(F.slice("f", 1, F.size("f") - 1), lambda x: x["id"])
    return rows.select("conv_id", ids.alias("ids"), F.transform(F.slice("f", 2, F.size("f") - 1), lambda x: F.when(x["t"], x["id"]).otherwise(-1)).alias("targets"))


def stitched_chats(pairs: DataFrame, n: int, seed: int = 5, digits: int = 3) -> DataFrame:
    """chat, slot, user, assistant: ``n`` conversations of two to four different pairs each.

    ``pairs`` is (key, user, assistant) with distinct keys.  Pairs are numbered in the order of a
    hash (ranks inside 16**digits slices and a running sum over their sizes), and a chat takes
    neighbours from a hashed place on.  Fewer than two pairs make no chats.
    """
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col("key")))
    rows = pairs.select("user", "assistant", "key", digest.alias("h")).withColumn("part", F.substring("h", 1, digits))
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("t"))
    total = sizes.agg(F.coalesce(F.sum("t"), F.lit(0))).first()[0]
    starts = sizes.select("part", F.coalesce(F.sum("t").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("part").orderBy("h", "key")))
    numbered = ranked.join(starts, "part").select((F.col("start") + F.col("r") - 1).alias("place"), "user", "assistant")
    if total < 2:
        return numbered.limit(0).select(F.col("place").alias("chat"), F.lit(0).alias("slot"), "user", "assistant")
    mark = F.md5(F.concat_ws(":", F.lit(seed), F.lit("chat"), F.col("id")))
    chats = pairs.sparkSession.range(n).select(F.col("id").alias("chat"), (F.conv(F.substring(mark, 1, 8), 16, 10).cast("long") % total).alias("base"), F.least(F.conv(F.substring(mark, 9, 4), 16, 10).cast("int") % 3 + 2, F.lit(int(total))).alias("k"))
    slots = chats.select("chat", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda s: (F.col("base") + s) % total)).alias("slot", "place"))
    return slots.join(numbered, "place").select("chat", "slot", "user", "assistant")
