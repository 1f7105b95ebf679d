"""Sharding by sampled splitters, with DataFrame functions only.

Records are ordered by a hash of their text, so that equal texts are neighbours, then cut into shards of near equal
bytes. A size-weighted sample of keys gives the quantile boundaries of many small ranges; ranges that still hold too
much (one text may be a third of all rows) are subdivided by a hash of the document. Exact byte and row counts of the
cells then place every record: its shard follows from the bytes before it, its slot from the rows before it. No task
sorts more than a cell, and only per-range and per-cell counts meet in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.llm.scratch import keep

_BLOCK = 28


def _not_above(values: Column, key: Column) -> Column:
    return F.size(F.filter(values, lambda v: v <= key))


def _longs(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})" if values else "cast(array() as array<bigint>)")


def range_of(key: Column, splitters: list[int]) -> Column:
    """Number of sorted splitters that are not above the key, found through the last one of each block."""
    block = _not_above(_longs(splitters[_BLOCK - 1 :: _BLOCK]), key) * _BLOCK
    return block + _not_above(F.slice(_longs(splitters), block + 1, F.lit(_BLOCK)), key)


def splitters(base: DataFrame, total: int, ranges: int, per_range: int, seed: int) -> list[int]:
    """Quantile boundaries of the keys of a sample in which a record's chance grows with its size.

    About ranges * per_range records are drawn, whatever the size of the input; a record larger than a sampling step
    counts as often as it covers steps.
    """
    draws = F.col("size") * (ranges * per_range / max(total, 1))
    chance = (F.xxhash64(F.lit(seed), "key", "doc_id", "size").bitwiseAND((1 << 53) - 1)) / float(1 << 53)
    row = (
        base.where(chance < draws)
        .agg(F.percentile("key", F.array(*[F.lit(i / ranges) for i in range(1, ranges)]), F.ceil(draws)).alias("q"))
        .first()
    )
    return sorted({int(q) for q in row.q or []})


def shard(
    docs: DataFrame,
    n_shards: int = 24,
    ranges_per_shard: int = 32,
    samples_per_range: int = 24,
    cell_rows: int = 1 << 20,
    seed: int = 17,
) -> DataFrame:
    """Every row of docs (doc_id, text, ...) with its shard and its slot there.

    Returns doc_id, size (UTF-8 bytes of the text plus 8), text_crc32, law ('bytes': shard sizes differ by about one
    record), shard (0 to n_shards - 1), slot (gapless from 0 within the shard), grown_shard (null: not this law).
    A null text has size 8 and CRC 0. Null ids and repeated rows are records like any other; repeated rows take
    neighbouring places. An empty table gives no rows. Other columns of docs are ignored.
    """
    text = F.col("text").cast("binary")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    crc = F.coalesce(F.crc32(text), F.lit(0)).cast("long")
    base = keep(
        docs.select(
            "doc_id",
            size.alias("size"),
            crc.alias("text_crc32"),
            F.shiftrightunsigned(F.xxhash64("text"), 12).alias("key"),
        ),
        "shard-keys",
    )
    sums = base.agg(F.sum("size").alias("bytes")).first()
    total, ranges = int(sums.bytes or 0), n_shards * ranges_per_shard

    ranged = base.withColumn("range", range_of(F.col("key"), splitters(base, total, ranges, samples_per_range, seed)))
    # At most `ranges` rows, whatever the input: small enough to broadcast.
    parts = ranged.groupBy("range").agg(
        F.greatest(
            F.ceil(F.sum("size") / F.lit(max(2 * total // ranges, 1))), F.ceil(F.count("*") / F.lit(cell_rows))
        ).alias("parts")
    )
    spread = F.xxhash64("doc_id", "text_crc32", F.lit(seed + 1))
    cells = ranged.join(F.broadcast(parts), "range").withColumn("sub", F.pmod(spread, F.col("parts")))

    order = Window.orderBy("range", "sub").rowsBetween(Window.unboundedPreceding, -1)
    places = (
        cells.groupBy("range", "sub")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .select(
            "range",
            "sub",
            F.coalesce(F.sum("bytes").over(order), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(order), F.lit(0)).alias("rows_before"),
        )
    )
    inside = Window.partitionBy("range", "sub").orderBy("key", "text_crc32", "size", "doc_id")
    before = F.col("bytes_before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    middle = before - F.expr("size div 2")
    placed = keep(
        cells.join(places, ["range", "sub"]).select(
            "doc_id",
            "size",
            "text_crc32",
            F.least(F.expr(f"{n_shards - 1}L"), F.floor(middle * n_shards / F.lit(max(total, 1)))).cast("int").alias("shard"),
            (F.col("rows_before") + F.row_number().over(inside) - 1).alias("row"),
        ),
        "shard-rows",
    )
    # One row per shard.
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
