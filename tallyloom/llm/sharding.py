"""Sharding by a permutation-filled lookup table, in DataFrame functions only.

Each shard has its own order of preference over the slots of a table of prime
size, from two hashes of its name: an offset and a skip. The shards take turns;
each claims the first slot of its order that is still free. A row's slot is its
key's hash modulo the table's size. The table has a fixed size, whatever the
data; broadcast, it places each row in constant time. When shards come or go,
few slots change hands.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode(), usedforsecurity=False).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def fill_table(shards: list[str], size: int) -> list[int]:
    """Number of the shard that holds each slot."""
    if not is_prime(size):
        raise ValueError("the table's size must be prime, so that every skip visits every slot")
    if not 0 < len(shards) <= size or len(set(shards)) < len(shards):
        raise ValueError("shards must be distinct, at least one, and no more than slots")
    place = [_number(f"offset:{s}") % size for s in shards]
    skip = [_number(f"skip:{s}") % (size - 1) + 1 for s in shards]
    table, free = [-1] * size, size
    while free:
        for k in range(len(shards)):
            while table[place[k]] >= 0:
                place[k] = (place[k] + skip[k]) % size
            table[place[k]] = k
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, size: int) -> Column:
    """The key's slot: the first 60 bits of its md5, modulo the size; a null key counts as empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % F.lit(size)).cast("int")


def table_frame(spark: SparkSession, shards: list[str], size: int) -> DataFrame:
    """``slot`` and ``shard``, one row per slot."""
    owners = ",".join(map(str, fill_table(shards, size)))
    slots = spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "owner"))
    return slots.select("slot", F.get(F.array(*map(F.lit, shards)), F.col("owner").cast("int")).alias("shard"))


def place_rows(rows: DataFrame, key: str, shards: list[str], size: int = 8191, keep: list[str] | None = None) -> DataFrame:
    """``row`` with ``slot`` and ``shard``.

    Every row is placed, also those with a null key (all in one shard), and
    equal keys are placed together; an empty table gives no rows. The broadcast
    side has ``size`` rows, a parameter, never data. No shuffle.
    """
    kept = rows.columns if keep is None else keep
    frame = rows.select(F.struct(*[rows[c] for c in kept]).alias("row"), slot_of(rows[key], size).alias("slot"))
    return frame.join(F.broadcast(table_frame(rows.sparkSession, shards, size)), "slot").select("row", "slot", "shard")
