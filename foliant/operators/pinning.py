"""A plan boundary the optimizer neither looks through nor moves conditions across."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def pinned(df: DataFrame) -> DataFrame:
    """The same rows, produced by a generator.

    Conditions on its columns stay above it, so a long chain of projections is not
    unfolded into a filter and run once more per use. Its columns are new to the
    planner, so a partitioning by them is not known any more: a join on them gets a
    shuffle of its own. Adaptive execution only splits a hot partition of a join
    whose two inputs are plain shuffles; the result of a ``distinct`` or ``groupBy``
    on the join key is none, and would leave the hot key to one task.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))
