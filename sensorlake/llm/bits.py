"""A bit table of fixed size over the hashes of a table, small enough to broadcast whatever its rows.

It answers "maybe" or "no". Users take it as a filter ahead of an exact step, so its false hits
cost time and never change a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.words import mixed


class BitTable:
    """``1 << size`` bits, two for each hash; picklable and read-only."""

    def __init__(self, size: int, table: np.ndarray):
        self.size, self.table = size, table

    @staticmethod
    def _places(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        shift = np.uint64(64 - size)
        return mixed(hashes) >> shift, mixed(hashes ^ np.uint64(0x9E3779B97F4A7C15)) >> shift

    @classmethod
    def of(cls, hashes: DataFrame, size: int) -> BitTable:
        """The table of the LONG column ``h``. Spark sets the bits; the driver joins the buckets."""

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                both = cls._places(batch.column("h").to_numpy().view(np.uint64), size)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(both).astype(np.int64) + 1)], ["bit"])

        buckets = (
            hashes.mapInArrow(places, "bit long")
            .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
        )
        table = np.zeros((1 << size) // 8, dtype=np.uint8)
        for row in buckets.collect():  # together as large as the table
            part = np.frombuffer(bytes(row.bits), dtype=np.uint8)
            begin = (row.bucket - 1) * part.size
            table[begin : begin + part.size] = part[: table.size - begin]
        return cls(size, table)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(hashes.size, dtype=bool)
        for place in self._places(hashes, self.size):
            found &= (self.table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found
