"""Placement of keys on shards by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a table of prime size. Shards take turns claiming the
first free slot of their order until the table is full. A key's hash names a slot and the slot its shard, so a
placement costs one lookup; shards hold almost equally many slots, and losing a shard moves few other keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slots of the table: a prime, at least a hundred times the shards.
SLOTS = 65_537
SHARDS = 64


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(names: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The shard number of each slot; size and cost depend on the parameters alone. Names must differ."""
    if not _is_prime(slots) or not 0 < len(names) <= slots or len(set(names)) < len(names):
        raise ValueError("slots must be prime, and names distinct, at least one and at most as many as slots")
    place, step = [], []
    for name in names:
        digest = hashlib.md5(name.encode()).digest()
        place.append(int.from_bytes(digest[:8], "big") % slots)
        step.append(int.from_bytes(digest[8:], "big") % (slots - 1) + 1)
    table, free, turn = [-1] * slots, slots, 0
    while free:
        while table[place[turn]] >= 0:
            place[turn] = (place[turn] + step[turn]) % slots
        table[place[turn]] = turn
        free, turn = free - 1, (turn + 1) % len(names)
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key's text: 60 bits of its MD5. A null key counts as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def place(rows: DataFrame, key: str, names: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``rows`` with ``slot`` and ``shard``; columns of these names are replaced.

    The table has ``slots`` rows whatever the input is, so it is broadcast. Equal keys go to one shard, so
    choose a key that tells rows apart. No row is moved or lost; null keys share a slot.
    """
    table = rows.sparkSession.createDataFrame(list(enumerate(lookup_table(names, slots))), "_slot int, _shard int")
    keyed = rows.drop("slot", "shard") if key not in ("slot", "shard") else rows
    keyed = keyed.withColumn("_at", slot_of(F.col(f"`{key}`"), slots))
    return keyed.join(F.broadcast(table), F.col("_at") == F.col("_slot")).withColumns(
        {"slot": F.col("_at"), "shard": F.col("_shard")}).drop("_at", "_slot", "_shard")


def write_shards(rows: DataFrame, key: str, names: Sequence[str], path: str, slots: int = SLOTS) -> None:
    """Write ``rows`` with one folder per shard; within a shard rows are spread over tasks by their slot."""
    placed = place(rows, key, names, slots)
    placed.repartition("shard", "slot").drop("slot").write.partitionBy("shard").parquet(path)
