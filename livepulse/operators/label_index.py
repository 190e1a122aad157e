"""Label filters by bitmaps: which games carry which labels, one bit a game.

Games are numbered once; for every label of every facet a bitmap tells the games that have it (in
buckets of 32,768 bits). A selection, any of the labels within a facet and all facets together, is a
bit-or and a bit-and over those bitmaps and one join with the numbers, however many facets it has;
without the index every facet is a semi join through its bridge.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from livepulse.session import materialize


@dataclass(frozen=True)
class LabelIndex:
    """``positions``: key, bucket, bit. ``bitmaps``: facet, label, bucket, bits."""
    key: str
    positions: DataFrame
    bitmaps: DataFrame

    def select(self, choice: dict[str, Sequence[str]]) -> DataFrame:
        """Keys of the games that have, for each facet with values, any of them. No values: all games."""
        wanted = {f: list(v) for f, v in choice.items() if v}
        if not wanted:
            return self.positions.select(self.key)
        hit = F.lit(False)
        for facet, values in wanted.items():
            hit = hit | ((F.col("facet") == facet) & F.col("label").isin(values))
        any_of = self.bitmaps.where(hit).groupBy("bucket", "facet").agg(F.bitmap_or_agg("bits").alias("bits"))
        all_of = any_of.groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("facets")) \
            .where(F.col("facets") == len(wanted)).select(F.col("bucket").alias("_bucket"), "bits")
        byte = F.conv(F.hex(F.substring("bits", F.shiftright("bit", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        there = F.call_function("shiftright", byte, (F.col("bit") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
        return self.positions.join(all_of, F.col("bucket") == F.col("_bucket")).where(there).select(self.key)


def label_index(games: DataFrame, facets: dict[str, str], key: str = "game_id") -> LabelIndex:
    """Index of ``games`` over the list columns ``facets`` ({facet: column}). The numbers are written once (an
    eager checkpoint), because bitmaps and selections must agree on them; null labels are none."""
    keyed = games.where(F.col(key).isNotNull())
    place = F.monotonically_increasing_id()
    numbered = materialize(keyed.select(key).distinct().withColumn("_at", place))
    at = F.col("_at")
    # Spark's bit of a number counts from one
    positions = numbered.select(key, F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit"))
    pairs = None
    for facet, column in facets.items():
        part = keyed.select(key, F.lit(facet).alias("facet"), F.explode(column).alias("label")).where(F.col("label").isNotNull())
        pairs = part if pairs is None else pairs.unionByName(part)
    bitmaps = pairs.join(positions, key).groupBy("facet", "label", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    return LabelIndex(key, positions, bitmaps)
