"""Running totals and maxima of a stream, kept in Spark's state store.

``carry`` gives every row of a micro-batch what its key had before that
micro-batch (sums or maxima of all earlier ones); running values inside the
micro-batch are a batch plan on top (``operators.running``), which cuts a hot
key into slices. The stateful step itself holds a few numbers per key and one
Arrow batch at a time: it sums while rows pass, so a key's rows are never
gathered in it.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

# Fold of each kind of measure, and what a key has before its first row.
FOLDS = {"sum": lambda old, values: (old or 0) + int(values.sum()),
         "max": lambda old, values: int(values.max()) if old is None else max(old, int(values.max()))}


def carry(stream: DataFrame, key: Sequence[str], measures: dict[str, tuple[str, Column]]) -> DataFrame:
    """``stream`` with a long column ``name`` per measure: the ``"sum"`` or
    ``"max"`` of the given (long, never null) expression over the key's rows of all
    earlier micro-batches; null before the first (0 for sums).

    Key columns must not be null. Output order inside a micro-batch is arbitrary.
    """
    names = list(measures)
    kinds = [measures[n][0] for n in names]
    rows = stream.select("*", *[measures[n][1].cast("long").alias(f"_m_{n}") for n in names])
    keep = stream.columns

    def fold(_key, frames, state):
        warnings.simplefilter("ignore", FutureWarning)  # pandas on Spark's own concatenation of empty state frames
        before = list(state.get) if state.exists else [0 if k == "sum" else None for k in kinds]
        now = list(before)
        for frame in frames:
            if len(frame):
                now = [FOLDS[kind](old, frame[f"_m_{n}"].to_numpy()) for n, kind, old in zip(names, kinds, now)]
            none = pd.Series(pd.NA, index=frame.index, dtype="Int64")
            yield frame[keep].assign(**{n: none if b is None else b for n, b in zip(names, before)})
        state.update(tuple(now))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields)
    longs = ", ".join(f"`{n}` long" for n in names)
    return (rows.groupBy(*key).applyInPandasWithState(fold, f"{fields}, {longs}", longs, "append", GroupStateTimeout.NoTimeout))


def carried(name: str, default: int | None = 0) -> Column:
    """The carried column, with a default where there is nothing before."""
    return F.col(name) if default is None else F.coalesce(F.col(name), F.lit(default).cast("long"))
