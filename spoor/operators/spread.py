"""Joining many rows of a key to the one row of that key, without hot tasks."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Positions of one key that stay together in a task.
BLOCK = 1024


def unbroadcast(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the history, as the other does: sorted and merged.

    Spark takes the rows of a generator for as many as its input and columnar files for as
    small as they are stored, and would send such a side to the driver and every executor.
    """
    return side.hint("merge")


def position_block(position: Column) -> Column:
    return F.floor(position / F.lit(BLOCK)).cast("long")


def spread_join(
    many: DataFrame,
    one: DataFrame,
    keys: list[str],
    block: Column,
    layout: DataFrame | None = None,
) -> DataFrame:
    """Inner join of ``many`` to ``one``, shuffled on the keys and a block.

    A key with a third of all rows becomes many blocks and so many tasks. The rows of
    ``one`` are repeated once per block their key really has, which for ordinary keys
    is once. ``layout`` may name a cheaper table with the same keys and positions.
    """
    layout = many if layout is None else layout
    blocks = layout.select(*keys, block.alias("_block")).distinct()
    return (
        many.withColumn("_block", block)
        .join(unbroadcast(blocks.join(unbroadcast(one), keys)), [*keys, "_block"])
        .drop("_block")
    )
