"""A bitmap of ids with a fixed size, to leave most rows out of a scan before an exact join."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 23


class IdFilter:
    """May say yes to ids that are not in it, never no to one that is.

    2**bits bits (1 MB as it stands) whatever the number of ids: with very many ids it lets more rows pass and the exact
    join behind it does the work.
    """

    def __init__(self, spark: SparkSession, ids: DataFrame, column: str, bits: int = BITS):
        place = F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(1 << bits))
        words = (
            ids.select(place.alias("place")).groupBy(F.shiftright("place", 5).alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(place & 31L as int)))").alias("set")).toArrow()
        )
        bitmap = np.zeros(1 << (bits - 5), np.uint32)
        bitmap[words["word"].to_numpy()] = words["set"].to_numpy().astype(np.uint32)
        self.bits, self.bitmap = bits, spark.sparkContext.broadcast(bitmap)

    def place(self, column: str = "doc_id"):
        """Expression that gives an id's place, to be handed to :meth:`passes`."""
        return F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(1 << self.bits))

    def passes(self, places: np.ndarray) -> np.ndarray:
        return (self.bitmap.value[places >> 5] >> (places & 31).astype(np.uint32)) & np.uint32(1) == 1
