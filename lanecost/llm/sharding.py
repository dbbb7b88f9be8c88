"""Jump consistent hashing: stable keys to shards without a ring table.

A key seeds the linear congruential generator of the published algorithm; the key
jumps from shard to shard, and the last landing below the number of shards is its
place. The landings do not depend on that number, so one more shard only takes the
keys that land on it. Everything is a column expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanecost.llm.common import numbered, utf8, written

# Multiplier and increment of the generator of jump consistent hashing.
MULTIPLIER = 2862933555777941757
INCREMENT = 1

_BITS = 22
_MASK = (1 << _BITS) - 1
_TOP = (1 << 20) - 1
_FACTORS = (MULTIPLIER & _MASK, MULTIPLIER >> _BITS & _MASK, MULTIPLIER >> 2 * _BITS)


def _limbs(key: Column) -> tuple[Column, Column, Column]:
    """An integer as three limbs of 22, 22 and 20 bits: their products fit a long, so
    that arithmetic modulo 2^64 never overflows."""
    return (
        key.bitwiseAND(_MASK),
        F.shiftrightunsigned(key, _BITS).bitwiseAND(_MASK),
        F.shiftrightunsigned(key, 2 * _BITS).bitwiseAND(_TOP),
    )


def _stepped(a: Column, b: Column, c: Column) -> tuple[Column, Column, Column]:
    """The generator's next state."""
    x, y, z = _FACTORS
    low = a * x + INCREMENT
    middle = a * y + b * x + F.shiftright(low, _BITS)
    high = a * z + b * y + c * x + F.shiftright(middle, _BITS)
    return low.bitwiseAND(_MASK), middle.bitwiseAND(_MASK), high.bitwiseAND(_TOP)


def jump_shards(key: Column, *shards: int) -> Column:
    """A struct ``s0``, ``s1``, ... with the shard of ``key``, a long, for each of the
    given numbers of shards. A null key counts as 0."""
    limbs = _limbs(F.coalesce(key.cast("long"), F.lit(0).cast("long")))
    names = [f"s{i}" for i in range(len(shards))]
    first = F.struct(
        *(limb.alias(n) for limb, n in zip(limbs, "abc", strict=True)),
        F.lit(0).cast("long").alias("next"),
        *(F.lit(0).cast("long").alias(n) for n in names),
    )

    def jump(state: Column, _: Column) -> Column:
        limbs = _stepped(state["a"], state["b"], state["c"])
        draw = F.shiftleft(limbs[2], 11).bitwiseOR(F.shiftright(limbs[1], 11)) + 1
        land = state["next"]
        target = F.floor((land + 1).cast("double") * (F.lit(float(1 << 31)) / draw.cast("double")))
        moved = F.struct(
            *(limb.alias(n) for limb, n in zip(limbs, "abc", strict=True)),
            target.cast("long").alias("next"),
            *(
                F.when(land < n, land).otherwise(state[name]).alias(name)
                for n, name in zip(shards, names, strict=True)
            ),
        )
        return F.when(land < max(shards), moved).otherwise(state)

    done = F.aggregate(F.sequence(F.lit(1), F.lit(max(shards))), first, jump)
    return F.struct(*(done[n].cast("int").alias(n) for n in names))


def shard_rows(
    docs: DataFrame,
    shards: int = 40,
    key: str = "doc_id",
    text: str = "text",
    rows_per_chunk: int = 5_000,
) -> DataFrame:
    """The place of every row: key, size, text_crc32, shard, slot, grown_shard.

    Size is the text's UTF-8 bytes plus 16; a null text has none and the checksum of an
    empty one. An integer key is used as it is, any other by its 64-bit hash, a null key
    as 0; rows with one key share its shard, also when their texts differ. Slots count
    from 0 in every shard. An empty table gives an empty table, and columns other than
    key and text are not read.
    """
    kind = docs.schema[key].dataType.typeName()
    number = F.col(key) if kind in ("byte", "short", "integer", "long") else F.xxhash64(key)
    number = F.when(F.col(key).isNull(), F.lit(0)).otherwise(number).cast("long")

    def placed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_at", jump_shards(number, shards, shards + 1))

    data = utf8(F.col(text))
    rows = placed(
        docs.select(key, (F.octet_length(data) + 16).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    ).select(key, "size", "text_crc32", F.col("_at.s0").alias("shard"), F.col("_at.s1").alias("grown_shard"))
    rows = written(rows, "placed")  # numbers and checksums, without the texts
    return numbered(rows, "shard", [key, "size", "text_crc32"], "slot", rows_per_chunk)


def write_shards(docs: DataFrame, path: str, shards: int = 40, key: str = "doc_id") -> None:
    """The rows themselves, one folder ``shard=<n>`` each, in files of one or more tasks:
    a shard of any size is written by many tasks."""
    kind = docs.schema[key].dataType.typeName()
    number = F.col(key) if kind in ("byte", "short", "integer", "long") else F.xxhash64(key)
    number = F.when(F.col(key).isNull(), F.lit(0)).otherwise(number).cast("long")
    placed = docs.withColumn("shard", jump_shards(number, shards)["s0"])
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
