"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime size (an offset and a step from the md5 of its
name). Shards take turns; at its turn a shard claims the first slot of its order that is still free, until all are taken. A row
goes to the shard that holds the slot of its key's md5. Shares differ by one slot at most, and when a shard leaves, few of the other rows
move. The table has `slots` rows whatever the data, which bounds what is broadcast.

Null key: the slot of the empty text. Repeated keys share a slot. Empty table: no rows. Other columns stay as they are, but for
`slot` and `shard`, which are overwritten.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetprep.llm.tables import only, query, table

SLOTS = 65_537
MOST_SLOTS = 1_000_003  # bounds the broadcast to some 30 MB
SHARDS = [f"shard-{k:04d}" for k in range(64)]


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def preference(name: str, slots: int) -> tuple[int, int]:
    """Offset and step of a shard's order."""
    digest = hashlib.md5(name.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:], "big") % (slots - 1) + 1


def fill(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """Of each slot, the index of the shard that holds it."""
    names = sorted(shards)
    if not names or len(set(names)) < len(names):
        raise ValueError("shards must have names, each once")
    if not is_prime(slots) or not len(names) <= slots <= MOST_SLOTS:
        raise ValueError(f"slots must be a prime number from the number of shards to {MOST_SLOTS}")
    taken, at = [-1] * slots, [preference(n, slots) for n in names]
    left = slots
    while True:
        for k, (slot, step) in enumerate(at):
            while taken[slot] >= 0:
                slot = (slot + step) % slots
            taken[slot] = k
            at[k] = (slot + step) % slots, step
            left -= 1
            if not left:
                return taken


def slot_of(key: Column, slots: int) -> Column:
    """60 bits of the key's md5, modulo the slots."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots


def place(df: DataFrame, key: str, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """df with `slot` and `shard`."""
    names = sorted(shards)
    rows = [(slot, names[k]) for slot, k in enumerate(fill(shards, slots))]
    lookup = df.sparkSession.createDataFrame(rows, "slot long, shard string")
    return df.drop("slot", "shard").withColumn("slot", slot_of(F.col(f"`{key}`"), slots)).join(F.broadcast(lookup), "slot")


def write_shards(df: DataFrame, key: str, path: str, shards: Sequence[str] = SHARDS, slots: int = SLOTS, files: int = 16) -> None:
    """One folder per shard; each shard's rows are spread over `files` tasks by slot, so that none has to hold a whole shard."""
    placed = place(df, key, shards, slots)
    placed.repartition(len(shards) * files, "shard", F.col("slot") % files).write.partitionBy("shard").parquet(path)


@query("op3_sharding")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place(only(table(spark, sf_dir, "documents"), "doc_id"), "doc_id").select("doc_id", "slot", "shard")
