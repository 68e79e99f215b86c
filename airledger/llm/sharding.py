"""Sharding by jump consistent hashing (DataFrame functions only).

A row's shard depends on its key and the number of shards and on nothing else; there is no
ring table. With one more shard a row stays or moves to the new shard, so only the share
1/(n+1) of the rows moves.

The published recurrence runs on a 64-bit generator ``key = key * M + 1``. Spark's ANSI
arithmetic raises on overflow, so the state is kept as two 32-bit halves in longs. The key is
the first 64 bits of md5(key text), which makes clustered keys as good as random ones.

Slots number a shard's rows without gaps. A shard may hold any share of the data, so it is
never sorted in one task: rows fall into ``slices`` fixed slices per shard, each slice is
numbered on its own, and slices are offset by the running total of the (shard, slice) counts,
a table of at most n_shards * slices rows. Both read the placed rows (a key, size, crc and
place each) from a stored table, so texts are read once. Rows equal in (key, size, crc) are interchangeable
in the result; they are counted before the shuffle and expanded at the end, so one key that
holds a third of the rows is one counted row until then.

Defined cases: a null key hashes as the empty text; a null text has 8 bytes and crc 0; repeated
rows each get a slot of their own; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airledger.llm.common import stored

#: Fixed value: the multiplier of the published jump hash generator, as 16- and 32-bit limbs.
MULTIPLIER = 2862933555777941757
_HIGH, _LOW1, _LOW0 = MULTIPLIER >> 32, (MULTIPLIER >> 16) & 0xFFFF, MULTIPLIER & 0xFFFF
_MASK32 = (1 << 32) - 1

ROW_OVERHEAD = 8
SLICES = 1024
EXPAND = 65536


def _word(hex_digits: Column) -> Column:
    return F.conv(hex_digits, 16, 10).cast("long")


def key_state(key: Column) -> tuple[Column, Column]:
    """High and low 32 bits of the key's 64-bit start value."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return _word(F.substring(digest, 1, 8)), _word(F.substring(digest, 9, 8))


def _next_state(hi: Column, lo: Column) -> tuple[Column, Column]:
    """(hi, lo) of state * MULTIPLIER + 1 mod 2^64; every product stays under 2^63."""
    low = lo * F.lit(_LOW0) + F.lit(1)
    mid = lo * F.lit(_LOW1)
    sum_low = low + F.shiftleft(mid.bitwiseAND(F.lit(0xFFFF)), 16)
    carry = F.shiftright(sum_low, 32) + F.shiftright(mid, 16)
    up = lo * F.lit(_HIGH)
    cross = hi * F.lit(_LOW0) + F.shiftleft((hi * F.lit(_LOW1)).bitwiseAND(F.lit(0xFFFF)), 16)
    mask = F.lit(_MASK32)
    return ((carry + up.bitwiseAND(mask) + cross.bitwiseAND(mask)).bitwiseAND(mask),
            sum_low.bitwiseAND(mask))


def jump_shards(key: Column, n_shards: int) -> Column:
    """struct(shard, grown): the key's shard of ``n_shards`` and of one more, in one walk: the
    walk's last stop below n is the shard, its last stop below n + 1 the grown one."""
    hi, lo = key_state(key)
    start = F.struct(hi.alias("hi"), lo.alias("lo"), F.lit(0).cast("long").alias("at"),
                     F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("grown"))

    def step(s: Column, _: Column) -> Column:
        hi, lo = _next_state(s["hi"], s["lo"])
        at = s["at"]
        ahead = F.floor((at + F.lit(1)) * (F.lit(2.0**31) / (F.shiftright(hi, 1) + F.lit(1))))
        return F.struct(hi.alias("hi"), lo.alias("lo"),
                        F.when(at > n_shards, at).otherwise(ahead).alias("at"),
                        F.when(at < n_shards, at).otherwise(s["shard"]).alias("shard"),
                        F.when(at <= n_shards, at).otherwise(s["grown"]).alias("grown"))

    def walked(state: Column, steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.lit(steps)), state, step)

    # a walk makes n + 1 stops below n + 1 at most, as each stop is beyond the one before, but about log n as a rule
    usual = 8 + 4 * n_shards.bit_length()
    if n_shards <= usual:
        end = walked(start, n_shards)
    else:  # the few walks that are not over yet go on
        end = F.get(F.transform(F.array(walked(start, usual)), lambda s: F.when(s["at"] > n_shards, s).otherwise(walked(s, n_shards))), 0)
    return F.get(F.transform(F.array(end), lambda s: F.struct(s["shard"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown"))), 0)


def assign_shards(rows: DataFrame, key: str, text: str, n_shards: int = 24, slices: int = SLICES) -> DataFrame:
    """Per row: the key column, size, text_crc32, law ('key'), shard, slot, grown_shard."""
    body = F.coalesce(F.col(text), F.lit(""))
    facts = rows.select(F.col(key), (F.octet_length(body).cast("long") + ROW_OVERHEAD).alias("size"),
                        F.crc32(body.cast("binary")).alias("text_crc32"))
    counted = facts.groupBy(key, "size", "text_crc32").agg(F.count(F.lit(1)).alias("__n"))
    spread = F.md5(F.concat_ws(":", F.col(key).cast("string"), "size", "text_crc32").cast("binary"))
    placed = stored(counted.withColumns({
        "__to": jump_shards(F.col(key), n_shards),
        "__slice": F.pmod(_word(F.substring(spread, 1, 8)), F.lit(slices)).cast("int"),
    }).select(key, "size", "text_crc32", "__n", "__slice",
              F.col("__to.shard").alias("shard"), F.col("__to.grown").alias("grown_shard")), "placed")

    before = Window.partitionBy("shard").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("shard", "__slice").agg(F.sum("__n").alias("__rows"))
               .select("shard", "__slice", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__from")))
    inside = (Window.partitionBy("shard", "__slice").orderBy(key, "size", "text_crc32")
              .rowsBetween(Window.unboundedPreceding, -1))
    numbered = (placed.withColumn("__first", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
                .join(F.broadcast(offsets), ["shard", "__slice"]))  # n_shards * slices rows at most
    runs = numbered.withColumn("__at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(EXPAND).cast("long"))))
    each = runs.withColumn("__i", F.explode(F.sequence(F.col("__at"), F.least(F.col("__at") + EXPAND, F.col("__n")) - 1)))
    return each.select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard",
                       (F.col("__from") + F.col("__first") + F.col("__i")).alias("slot"), "grown_shard")
