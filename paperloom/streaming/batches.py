"""User functions over batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from paperloom import constants as C


def batch_process(
    rows: DataFrame,
    function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    size: int = C.BATCH_ROWS,
) -> DataFrame:
    """Call `function` with batches of `size` rows and collect what it returns.

    Every partition is cut into batches of exactly `size` (its last may be smaller), and
    partitions run in parallel; works on streams too. Select the columns needed first.
    """

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame()
        for frame in frames:
            held = pd.concat([held, frame], ignore_index=True) if len(held) else frame
            while len(held) >= size:
                yield function(held.iloc[:size].reset_index(drop=True))
                held = held.iloc[size:]
        if len(held):
            yield function(held.reset_index(drop=True))

    return rows.mapInPandas(batches, schema)
