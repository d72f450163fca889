"""Chat formatting with cumulative-snapshot collapse.

Logs often hold a conversation several times, each time a few turns longer.
Rolling hashes over the turns identify each prefix of each conversation; an
anti-join drops the conversations that are a proper prefix of another, and a
grouping those that repeat one. What is left is rendered.

All but the rendering works on digests: texts take part only where two turns of
one conversation have the same number, and move once their conversation is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.plans.scratch import materialised


def _digest(seed: int, *parts: Column) -> Column:
    """Hash of some values; nulls and empty texts differ."""
    return F.xxhash64(F.lit(seed), *[F.coalesce(F.concat(F.lit("+"), p.cast("string")), F.lit("-")) for p in parts])


def _before(rows: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Sums over all earlier cells of the same conversation, for each ``run`` (conversation and cell)."""
    earlier = Window.partitionBy("run.conv").orderBy("run.cell").rowsBetween(Window.unboundedPreceding, -1)
    per_run = rows.groupBy("run").agg(*[c.alias(name) for name, c in sums.items()])
    return per_run.select("run", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in sums])


def keyed_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``at`` (conversation and turn number, a struct, so that nulls compare equal), ``role``, ``text`` and two digests of these."""
    at = F.struct(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn")).alias("at")
    return turns.select(at, F.col(role).alias("role"), F.col(text).alias("text"), *[_digest(seed, F.col(role), F.col(text)).alias(f"d{seed}") for seed in (1, 2)])


def numbered_turns(keyed: DataFrame) -> DataFrame:
    """``at``, the turn's digests, its ``place`` from 1 and two rolling hashes ``m1``, ``m2`` of the turns up to it.

    The order (number, role, text; equal rows in any order) is cut into ranges
    over all conversations, so that a long one is not one task's, nor is a turn
    number that many rows share. A range is written before it is used: a
    retried task can't see other bounds. Running sums of counts give the
    places, those of hashes of (place, role, text) the rolling hashes, inside a
    range by a window and over the ranges by their sums.
    """
    spark = keyed.sparkSession
    differ = (F.min("d1") != F.max("d1")) | (F.min("d2") != F.max("d2"))
    tied = materialised(keyed.groupBy("at").agg(differ.alias("differ")).filter("differ"), "chat-ties")
    order = [F.col(c).asc_nulls_first() for c in ("at.conv", "at.turn", "tie.role", "tie.text", "spread")]
    rows = keyed.join(tied, "at", "left").select("at", "d1", "d2", F.when(F.col("differ"), F.struct("role", "text")).alias("tie"), F.monotonically_increasing_id().alias("spread"))
    ranged = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
    ranged = materialised(ranged.withColumn("run", F.struct(F.col("at.conv").alias("conv"), F.spark_partition_id().alias("cell"))), "chat-order")
    inside = Window.partitionBy("run").orderBy(*order)
    ranked = ranged.withColumn("rank", F.row_number().over(inside)).join(_before(ranged, {"offset": F.count("*")}), "run")
    placed = ranked.select("run", "at", "d1", "d2", (F.col("rank") + F.col("offset")).alias("place"))
    hashed = placed.select("*", *[_digest(seed, F.col("place"), F.col("d1"), F.col("d2")).cast("decimal(38,0)").alias(f"h{seed}") for seed in (1, 2)])
    upto = Window.partitionBy("run").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rolled = hashed.select("*", *[F.sum(f"h{k}").over(upto).alias(f"r{k}") for k in (1, 2)]).join(_before(hashed, {f"o{k}": F.sum(f"h{k}") for k in (1, 2)}), "run")
    marks = [_digest(k, F.col("place"), (F.col(f"r{k}") + F.col(f"o{k}")).cast("decimal(38,0)")).alias(f"m{k}") for k in (1, 2)]
    return materialised(rolled.select("at", "d1", "d2", "place", *marks), "chat-places")


def maximal_conversations(numbered: DataFrame) -> DataFrame:
    """``conv`` (a struct of the id) and ``n_turns`` of the conversations that no other one continues, each but once (smallest id, null last).

    A prefix that occurs more often than conversations end with it goes on in some conversation.
    """
    ends = numbered.groupBy("at.conv").agg(F.max(F.struct("place", "m1", "m2")).alias("end"))
    whole = ends.groupBy("end.place", "end.m1", "end.m2").agg(F.min(F.struct(F.col("conv").isNull().alias("none"), "conv")).alias("first"), F.count("*").alias("ending"))
    prefixes = numbered.groupBy("place", "m1", "m2").agg(F.count("*").alias("having"))
    going_on = prefixes.join(whole.select("place", "m1", "m2", "ending"), ["place", "m1", "m2"]).filter("having > ending")
    whole = whole.join(going_on, ["place", "m1", "m2"], "left_anti")
    return whole.select(F.struct("first.conv").alias("conv"), F.col("place").alias("n_turns"))


def render_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", page: int = 256,
    opening: str = "<|", middle: str = "|>\n", closing: str = "<|end|>\n",
) -> DataFrame:
    """``conv_id``, ``page``, ``n_turns`` and the page's ``rendered`` text, for maximal conversations only.

    A page holds ``page`` turns, so a conversation of any length renders in
    rows of bounded size; its pages in order are its text. Turns are ordered by
    number, then role and text; a null number comes first, a null role renders
    as ``unknown`` and a null text as empty. Rows with a null id are one
    conversation. Of equal conversations the one with the smallest id stays; an
    empty table gives no rows; further columns are ignored.
    """
    keyed = keyed_turns(turns, conv, turn, role, text)
    numbered = numbered_turns(keyed)
    kept = materialised(maximal_conversations(numbered), "chat-kept")
    own = F.struct("at.conv").alias("conv")
    pieces = numbered.select(own, "at", "d1", "d2", "place").join(kept, "conv")
    pieces = pieces.groupBy("at", "d1", "d2", F.floor((F.col("place") - 1) / page).alias("page")).agg(F.first("n_turns").alias("n_turns"), F.min("place").alias("place"), F.count("*").cast("int").alias("times"))
    line = F.concat(F.lit(opening), F.coalesce("role", F.lit("unknown")), F.lit(middle), F.coalesce("text", F.lit("")), F.lit("\n" + closing))
    lines = keyed.select(own, "at", "d1", "d2", line.alias("line")).join(kept, "conv", "left_semi").groupBy("at", "d1", "d2").agg(F.first("line").alias("line"))
    parts = pieces.join(lines, ["at", "d1", "d2"])
    pages = parts.groupBy("at.conv", "page").agg(F.first("n_turns").alias("n_turns"), F.array_sort(F.collect_list(F.struct("place", "times", "line"))).alias("lines"))
    return pages.select(F.col("conv").alias("conv_id"), "page", "n_turns", F.array_join(F.transform("lines", lambda x: F.repeat(x.line, x.times)), "").alias("rendered"))
