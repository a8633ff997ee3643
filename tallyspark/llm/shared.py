"""Helpers the training-data operators share.

Intermediate tables go to the shared work folder (``spark.checkpoint.dir``),
so a lost executor never takes one with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tallyspark.session import released_shuffles, scratch_path

#: Bytes of text handed to one numpy step; bounds a task's memory however
#: many rows Spark puts into an Arrow batch.
BLOCK_BYTES = 4 << 20


def stored(spark: SparkSession, df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` under the shared work folder (to ``path``, where given)
    and read it back: cuts the lineage and fixes what a later pass sees."""
    path = path or scratch_path(spark, name)
    with released_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def neutral(docs: DataFrame, kept: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with every column but the ``kept`` ones under a name of ours,
    by place, and what gives a result with the same columns its names back.
    So columns of any name, also one with a dot or one that a stage uses
    itself, pass through a stage unharmed."""
    names, kept = docs.columns, set(kept)
    renamed = docs.toDF(*[n if n in kept else f"col_{i}" for i, n in enumerate(names)])
    return renamed, lambda out: out.toDF(*names)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: each holds about ``limit`` bytes of
    ``column``, or one row if that row alone is longer."""
    for batch in batches:
        lengths = batch.column(column)
        lengths = pc.fill_null(pc.binary_length(lengths), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(lengths):
            yield batch.slice(start, len(lengths) - start)
