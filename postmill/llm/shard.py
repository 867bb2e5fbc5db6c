"""Sharding by a Feistel permutation of global row numbers.

Rows get numbers 0 .. n-1: they are dealt into blocks of some ``BLOCK_ROWS`` rows at most (``BLOCKS`` blocks
at least) by hash, numbered inside their block, and a block starts where the ones before it end. A Feistel network with cycle walking
permutes 0 .. n-1; the permuted number p gives ``shard = p mod shards`` and ``slot = p div shards``,
so both can be computed for any row number, and shard counts are at most one apart (law ``rows``).

Null ids and texts are ordinary values. Equal rows get different numbers; which of them gets which
makes no difference. Texts of any length count whole, by size and checksum. Columns of any name are carried along in
one struct; ``shard`` and ``slot`` replace those of the same name. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, text_of, tie_break

SHARDS = 24
BLOCKS = 4096
BLOCK_ROWS = 65_536
WALK = 64
SEED = 20_240_607
PRIME = 2_147_483_647
FACTOR = 48_271


def round_keys(seed: int, rounds: int = 5) -> list[tuple[int, int]]:
    """Two keys below 2^30 for each double round."""
    keys, x = [], seed % PRIME or 1
    for _ in range(2 * rounds):
        x = x * FACTOR % PRIME
        keys.append(x % (1 << 30))
    return list(zip(keys[::2], keys[1::2], strict=True))


def sides(n: int) -> tuple[int, int]:
    """Width and height of the smallest near-square rectangle of n cells at least."""
    a = int(max(n, 1) ** 0.5)
    while a * a < n:
        a += 1
    a = max(a, 1)
    return a, max(1, -(-n // a))


def _mixed(value: Column, key: Column) -> Column:
    squared = F.pmod((value + key) * (value + key + 1), F.lit(PRIME))
    return F.pmod(squared * F.lit(FACTOR) + key, F.lit(PRIME))


def _encrypt(number: Column, a: Column, b: Column, keys: list[tuple[int, int]]) -> Column:
    """One pass of the network over Z_a x Z_b."""
    rounds = F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(m).cast("long").alias("m")) for k, m in keys])

    def step(state: Column, key: Column) -> Column:
        x = F.pmod(state["x"] + _mixed(state["y"], key["k"]), a)
        y = F.pmod(state["y"] + _mixed(x, key["m"]), b)
        return F.struct(x.alias("x"), y.alias("y"))

    start = F.struct(F.floor(number / b).cast("long").alias("x"), F.pmod(number, b).alias("y"))
    return F.aggregate(rounds, start, step, lambda s: s["x"] * b + s["y"])


def permute(number: Column, n: Column, a: Column, b: Column, seed: int = SEED) -> Column:
    """The place of row ``number`` of ``n``; a x b >= n is the network's domain.

    A value outside 0 .. n-1 is sent through the network again. It leaves the surplus of the domain
    after as many steps as the surplus has values, at most; only rows that need it walk. Where the surplus is above
    ``WALK``, it is less than one in ``WALK`` of the domain, so that many steps are never used up; the job fails if they are.
    """
    keys = round_keys(seed)
    once = _encrypt(number, a, b, keys)
    surplus = F.sequence(F.lit(1).cast("long"), F.least(a * b - n, F.lit(WALK).cast("long")))
    walked = F.aggregate(surplus, once, lambda v, _: F.when(v < n, v).otherwise(_encrypt(v, a, b, keys)))
    walked = F.when(walked < n, walked).otherwise(F.raise_error(F.lit("a row number still walks outside of the table")).cast("long"))
    return F.when(once < n, once).otherwise(walked)


def number_rows(rows: DataFrame, block: str, order: list[str], blocks: int) -> DataFrame:
    """Add ``row_no`` (0 .. n-1) and ``n_rows``; ``block`` holds values below ``blocks``."""
    counts = rows.groupBy(block).agg(F.count("*").alias("in_block"))
    # One row a block: at most `blocks` rows, whatever the size of the table.
    before = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        block,
        F.coalesce(F.sum("in_block").over(before), F.lit(0).cast("long")).alias("first"),
        F.sum("in_block").over(Window.partitionBy()).alias("n_rows"),
    )
    inside = F.row_number().over(Window.partitionBy(block).orderBy(*order)) - 1
    return rows.withColumn("inside", inside).join(F.broadcast(starts), block).withColumn("row_no", F.col("first") + F.col("inside"))


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, blocks: int | None = None, kept: list[str] | None = None) -> DataFrame:
    """Columns ``row`` (all of ``docs``, or those ``kept``), ``size``, ``text_crc32``, ``row_no``, ``n_rows``, ``shard``, ``slot``."""
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    if blocks is None:  # they depend on the table alone, as row numbers do on them
        blocks = max(BLOCKS, -(-docs.count() // BLOCK_ROWS))
    text = F.encode(text_of(), "UTF-8")
    rows = docs.select(
        packed(docs.select(kept or "*")).alias("row"),
        F.col("doc_id").alias("id"),
        (F.octet_length(text_of()) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        tie_break(docs).alias("tie"),
    ).withColumn("block", F.pmod(F.xxhash64("id", "text_crc32"), F.lit(blocks)))
    numbered = number_rows(rows, "block", ["id", "text_crc32", "size", "tie"], blocks)
    a = F.ceil(F.sqrt(F.col("n_rows").cast("double"))).cast("long")
    numbered = numbered.withColumn("a", a).withColumn("b", F.ceil(F.col("n_rows") / F.col("a")).cast("long"))
    placed = numbered.withColumn("place", permute(F.col("row_no"), F.col("n_rows"), F.col("a"), F.col("b"), seed))
    return placed.select(
        "row", "size", "text_crc32", "row_no", "n_rows",
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("place") / shards).cast("long").alias("slot"),
    )


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``; columns of these names in the input give way."""
    kept = [name for name in docs.columns if name.lower() not in ("shard", "slot")]
    return shard_rows(docs, shards, seed).select(*[F.col(f"row.`{name}`").alias(name) for name in kept], "shard", "slot")


def op10(docs: DataFrame) -> DataFrame:
    return shard_rows(docs.select("doc_id", "text"), kept=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), "size", "text_crc32",
        F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_no", "n_rows",
    )
