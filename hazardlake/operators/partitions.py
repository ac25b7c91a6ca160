"""A function over record batches, for what expressions cannot say."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply a pandas function to Arrow batches; no batch sees another."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)


def coerce_partitions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns to 32-bit floats batch by batch; unreadable text is missing."""
    wanted = set(columns)
    fields = [f"`{f.name}` {'float' if f.name in wanted else f.dataType.simpleString()}" for f in df.schema.fields]

    def coerce(batch: pd.DataFrame) -> pd.DataFrame:
        return batch.assign(**{c: pd.to_numeric(batch[c], errors="coerce").astype("float32") for c in columns})

    return map_batches(df, coerce, ", ".join(fields))
