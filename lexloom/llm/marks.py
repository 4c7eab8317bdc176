"""A bitmap of fixed size that says which keys need not move.

Of a table of keys a bit each is set, at a place told by the key's hash.  A row whose bit is not set
has none of these keys, and is dealt with where it is read; only the others go through a join, which
decides.  So the bitmap never changes a result, and of the rows that need no join few move.  It has
``BITS`` bits (4 MB) and is broadcast; with far more keys than that all bits are set and every row
moves, as it would without.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexloom.llm import store

BITS = 1 << 25


class Marks:
    """The bits of the column ``key`` of a table."""

    def __init__(self, keys: DataFrame, key: str):
        self.bits = BITS
        at = keys.select(self._place(F.col(key)).alias("at"))
        table = at.groupBy(F.bitmap_bucket_number("at").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("_bitmap"))
        self.table = store.materialise(table, "marks")

    def _place(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.bits)) + 1

    def tested(self, rows: DataFrame, key: str, name: str) -> DataFrame:
        """``rows`` with a boolean ``name``: false where ``key`` is none of the keys."""
        placed = rows.withColumn("_at", self._place(F.col(key)))
        placed = placed.withColumn("_own", F.bitmap_bucket_number("_at")).withColumn("_bit", F.bitmap_bit_position("_at"))
        found = placed.join(F.broadcast(self.table), placed["_own"] == F.col("_bucket"), "left")
        byte = F.expr("cast(conv(hex(substring(_bitmap, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int)")
        bit = F.coalesce(F.expr("cast(_bit % 8 as int)"), F.lit(0))
        is_set = F.coalesce(byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), bit + 1)) > 0, F.lit(False))
        return found.withColumn(name, is_set).drop("_at", "_own", "_bit", "_bucket", "_bitmap")
