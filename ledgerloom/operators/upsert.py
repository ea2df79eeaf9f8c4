"""Merging a batch into a table by key.

The result is a new frame: write it to a new version of the table and swap, never over the path it reads.
With both tables bucketed by the key (``write_bucketed``) the merge reads them without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

LAST, FIRST = "last_wins", "first_wins"


def fold_batch(batch: DataFrame, keys: list[str], order_by: list[str], policy: str = LAST) -> DataFrame:
    """One record per key: the last or the first in ``order_by`` order. Records without a key drop out.

    The pick is an aggregate that combines before the shuffle, so a hot key costs one row per task.
    """
    props = [c for c in batch.columns if c not in keys and c not in order_by]
    keyed = batch.dropna(subset=keys)
    if not props:
        return keyed.select(*keys).distinct()
    pick = F.max_by if policy == LAST else F.min_by
    folded = keyed.groupBy(*keys).agg(pick(F.struct(*props), F.struct(*order_by)).alias("_p"))
    return folded.select(*keys, "_p.*")


def upsert(
    existing: DataFrame,
    batch: DataFrame,
    keys: list[str],
    order_by: list[str],
    policy: str = LAST,
    create_only: tuple[str, ...] = (),
) -> DataFrame:
    """Folds the batch to one record per key and merges it, see :func:`merge_folded`."""
    return merge_folded(existing, fold_batch(batch, keys, order_by, policy), keys, policy, create_only)


def merge_folded(
    existing: DataFrame,
    batch: DataFrame,
    keys: list[str],
    policy: str = LAST,
    create_only: tuple[str, ...] = (),
) -> DataFrame:
    """Batch columns replace those of matching rows (``last_wins``) or only fill new rows (``first_wins``).

    The batch has one row per key. Columns in ``create_only`` are set on new rows only, whatever the
    policy. A null in the batch counts as a value; which side a row came from is carried by a flag.
    """
    new = batch.withColumn("_new", F.lit(True)).alias("n")
    old = existing.withColumn("_old", F.lit(True)).alias("o")
    joined = old.join(new, keys, "full")
    old_columns = [c for c in existing.columns if c not in keys]
    new_columns = [c for c in new.columns if c not in keys and c != "_new"]

    def merged(column: str):
        if column not in new_columns:
            return F.col(f"o.{column}")
        if column not in old_columns:
            kept = F.lit(None)
        else:
            kept = F.col(f"o.{column}")
        if policy == FIRST or column in create_only:
            return F.when(F.col("_old"), kept).otherwise(F.col(f"n.{column}")).alias(column)
        return F.when(F.col("_new"), F.col(f"n.{column}")).otherwise(kept).alias(column)

    columns = old_columns + [c for c in new_columns if c not in old_columns]
    return joined.select(*keys, *[merged(c) for c in columns])


def load_counts(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """What a load does, as rows (step, rows): records in the batch, without a key, keys, keys created and updated."""
    keyed = batch.select(*keys).dropna(subset=keys)
    per_key = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("records"))
    known = existing.select(*keys).distinct().withColumn("_old", F.lit(True))
    matched = per_key.join(known, keys, "left").agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("keyed"),
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("_old").isNull()).alias("created"),
        F.count_if("_old").alias("updated"),
    )
    total = batch.agg(F.count(F.lit(1)).alias("records"))
    both = total.join(F.broadcast(matched), how="cross")  # one row on either side
    both = both.withColumn("no key", F.col("records") - F.col("keyed")).drop("keyed")
    return both.unpivot([], ["records", "no key", "keys", "created", "updated"], "step", "rows")


def counted(frame: DataFrame, name: str = "load") -> tuple[DataFrame, Observation]:
    """The frame with a row counter that is filled by whichever action runs it."""
    seen = Observation(name)
    return frame.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_bucketed(frame: DataFrame, table: str, keys: list[str], buckets: int) -> None:
    """Saves a table bucketed and sorted by its key, so merges and joins on the key need no shuffle."""
    frame.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
