"""Adding columns that an Arrow function computes, for any further columns a table may have."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from sensorlake.llm.words import pieces

Compute = Callable[[pa.RecordBatch], dict[str, pa.Array]]

#: Rows of a batch between Spark and Python. Texts are long, and a batch is held on both sides.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lower the session's batch size to ``BATCH_ROWS``; it bounds memory and changes no result.

    For programs that own their session, as the registered queries do. Operators leave the session as it is.
    """
    if int(spark.conf.get(_BATCH_SETTING, "10000")) not in range(1, BATCH_ROWS + 1):
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


def annotate(
    df: DataFrame, text: str, added: Sequence[StructField], compute: Compute, keep: Sequence[str] | None = None,
    most_bytes: int = 1 << 20, where: Callable[[pa.RecordBatch], pa.Array] | None = None,
) -> DataFrame:
    """``df`` with the columns that ``compute`` makes from slices of its rows.

    ``keep`` names the input columns to return, all by default. An input column whose name equals
    that of an added one, in any case, is replaced by it. ``where`` chooses the rows to return, all
    by default, ahead of the work on them.
    """
    clash = {field.name.lower() for field in added}
    kept = [name for name in (df.columns if keep is None else keep) if name.lower() not in clash]
    schema = StructType([*(df.schema[name] for name in kept), *added])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text, most_bytes):
            if where is not None:
                piece = piece.filter(where(piece))
            new = compute(piece)
            columns = [*(piece.column(name) for name in kept), *(new[field.name] for field in added)]
            shaped = [c if c.type == f.type else c.cast(f.type) for c, f in zip(columns, target, strict=True)]
            yield pa.RecordBatch.from_arrays(shaped, schema=pa.schema([pa.field(f.name, c.type) for f, c in zip(target, shaped, strict=True)]))

    return df.mapInArrow(run, schema)


def set_aside(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """``df`` with columns renamed whose names, in any case, are among ``names``; and its columns by their old names."""
    taken = {name.lower() for name in names}
    other = {name: f"{name}__set_aside" for name in df.columns if name.lower() in taken}
    return df.withColumnsRenamed(other), [F.col(f"`{other.get(name, name)}`").alias(name) for name in df.columns]


def list_array(values: pa.Array, lengths) -> pa.Array:
    """One list per row from the rows' concatenated values."""
    import numpy as np

    bounds = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=bounds[1:])
    return pa.ListArray.from_arrays(pa.array(bounds), values)
