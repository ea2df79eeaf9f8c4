"""Keeping linked lists up to date: after a change only the blocks of positions around it are linked again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.graph import SECTION_KEYS
from ledgerloom.operators.split_groups import BLOCK_ROWS, next_in_group

BLOCK = "block"


def linked(
    nodes: DataFrame, keys: list[str] | None = None, position: str = "chunkSeqId", node_id: str = "chunkId", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """A list that can be kept up to date: keys, block of the source, src, dst. See :func:`relink`."""
    keys = keys or SECTION_KEYS
    following = next_in_group(nodes.select(*keys, position, node_id), keys, position, node_id, block_rows)
    return _edges(following.withColumn(BLOCK, _block(position, block_rows)), keys, node_id, F.col("next_value"))


def relink(
    edges: DataFrame,
    nodes: DataFrame,
    changed: DataFrame,
    keys: list[str] | None = None,
    position: str = "chunkSeqId",
    node_id: str = "chunkId",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """What :func:`linked` gives for ``nodes``, made from the ``edges`` it gave before the change.

    ``nodes`` are those after the change; ``changed`` holds keys and position of every node that was put in, taken out or
    exchanged, repeats allowed. Blocks with a changed position, and those just before one, are linked anew; edges of all
    other blocks stay as they are. Positions are integers, unique within their list. A null key is a key like any other.
    """
    keys = keys or SECTION_KEYS
    place = [*keys, BLOCK]
    touched = changed.select(*keys, _block(position, block_rows).alias(BLOCK)).distinct()
    slim = nodes.select(*keys, position, node_id).withColumn(BLOCK, _block(position, block_rows))
    in_touched_lists = _matched(slim, touched.select(*keys).distinct(), keys, "left_semi")
    # One row per block of the lists that changed. A block that lost all its nodes has no head, but is known to be touched.
    heads = in_touched_lists.groupBy(*place).agg(F.min_by(node_id, position).alias("head"))
    blocks = (
        heads.withColumn("touched", F.lit(False))
        .unionByName(touched.withColumns({"head": F.lit(None).cast(heads.schema["head"].dataType), "touched": F.lit(True)}))
        .groupBy(*place)
        .agg(F.max("head").alias("head"), F.max("touched").alias("touched"))
    )
    backwards = Window.partitionBy(*keys).orderBy(F.desc(BLOCK))
    stale = blocks.withColumns(
        {
            "next_head": F.last("head", ignorenulls=True).over(backwards.rowsBetween(Window.unboundedPreceding, -1)),
            "before_touched": F.coalesce(F.lag("touched").over(backwards), F.lit(False)),
        }
    ).filter(F.col("touched") | F.col("before_touched"))
    again = _matched(in_touched_lists, stale.select(*place, "next_head"), place, "inner")
    inside = F.lead(node_id).over(Window.partitionBy(*place).orderBy(position))
    fresh = _edges(again.withColumn("next_value", F.coalesce(inside, "next_head")), keys, node_id, F.col("next_value"))
    return _matched(edges, stale.select(*place), place, "left_anti").unionByName(fresh)


def _block(position: str, block_rows: int) -> Column:
    return F.floor(F.col(position) / block_rows)


def _edges(frame: DataFrame, keys: list[str], node_id: str, following: Column) -> DataFrame:
    return frame.filter(following.isNotNull()).select(*keys, BLOCK, F.col(node_id).alias("src"), following.alias("dst"))


def _matched(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """A join on keys where nulls are equal; columns of the right side that are no keys are added by an inner join."""
    renamed = right.withColumnsRenamed({name: f"_r{n}" for n, name in enumerate(on)})
    same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_r{n}")) for n, name in enumerate(on)])
    return left.join(renamed, same, how).drop(*[f"_r{n}" for n in range(len(on))])
