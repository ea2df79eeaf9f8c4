"""Per-group order work that splits a group into bounded blocks.

A window or a collect over a whole group runs in one task, which fails when one group holds a third of
all rows. Here a group is cut by its integer position into blocks, each block is its own shuffle group,
and only one row per block takes part in the step that joins the blocks up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 8192


def next_in_group(
    frame: DataFrame, keys: list[str], position: str, value: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Adds ``next_value``: the value at the next higher position of the same group, null at its end.

    ``position`` must be an integer that is unique within the group; gaps are fine.
    """
    block = "_block"
    by_block = Window.partitionBy(*keys, block).orderBy(position)
    inside = frame.withColumn(block, F.floor(F.col(position) / block_rows)).withColumns(
        {"_next": F.lead(value).over(by_block), "_before": F.lag(position).over(by_block)}
    )
    # The head of each block, matched to the block before it. Heads are told by what stands before them and
    # not by a rank, so that both sides read the same shuffle and the input is computed once.
    heads = inside.filter(F.col("_before").isNull()).select(*keys, block, F.col(value).alias("_head"))
    following = heads.select(
        *keys, block, F.lead("_head").over(Window.partitionBy(*keys).orderBy(block)).alias("_next_head")
    ).filter(F.col("_next_head").isNotNull())
    # A null key is a group like any other, here as in the windows.
    same = F.lit(True)
    for n, name in enumerate([*keys, block]):
        same = same & F.col(name).eqNullSafe(F.col(f"_f{n}"))
    return (
        inside.join(following.select(*[F.col(c).alias(f"_f{n}") for n, c in enumerate([*keys, block])], "_next_head"), same, "left")
        .withColumn("next_value", F.coalesce("_next", "_next_head"))
        .drop(block, "_next", "_before", "_next_head", *[f"_f{n}" for n in range(len(keys) + 1)])
    )


def ordered_text(
    frame: DataFrame, keys: list[str], position: str, text: str, part_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Texts of a group joined in order without a separator, as (keys, part, parts, text).

    A part holds ``part_rows`` positions, so no task or cell holds more. ``parts`` says how many parts the group has:
    where it is 1 the text is whole, else the parts give it when read in order.
    """
    pieces = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(text).alias("t"))))
    parts = (
        frame.withColumn("part", F.floor(F.col(position) / part_rows))
        .groupBy(*keys, "part")
        .agg(F.array_join(F.transform(pieces, lambda x: x["t"]), "").alias("text"))
    )
    counted = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return parts.withColumn("parts", counted).select(*keys, "part", "parts", "text")
