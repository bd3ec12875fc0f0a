"""Flag every party whose duplicate key was seen earlier in ingest order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from entigrid.schema import POSITION
from entigrid.sources.provenance import numbered
from entigrid.sources.stored import stored

# Keys with more than one row in HOT_KEYS are matched by a broadcast; there are no more of them
# than that. Counts are estimated, never too low; the result does not depend on them.
HOT_KEYS = 1024
TRACKED_KEYS = 4 * HOT_KEYS
SKETCHES = 256


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """The keys that have more than one row in ``HOT_KEYS``, from frequent-items sketches.

    Tasks send a sketch each to one of ``SKETCHES``, which are combined in turn. No key that is
    left can swamp a task.
    """
    part = (F.spark_partition_id() % SKETCHES).alias("part")
    sketches = rows.groupBy(part).agg(
        F.expr(f"approx_top_k_accumulate({key}, {TRACKED_KEYS})").alias("sketch"), F.count("*").alias("rows")
    )
    # grouped, so that nothing comes of no rows
    whole = sketches.groupBy(F.lit("all").alias("all")).agg(
        F.expr(f"approx_top_k_combine(sketch, {TRACKED_KEYS})").alias("sketch"), F.sum("rows").alias("rows")
    )
    top = whole.select("rows", F.explode(F.expr(f"approx_top_k_estimate(sketch, {HOT_KEYS})")).alias("top"))
    return top.filter(F.col("top.count") * HOT_KEYS > F.col("rows")).select(F.col("top.item").alias("hot_key"))


def first_of(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """(hot_key, first_pos, first_id) of a few keys; rows are combined before the shuffle."""
    own = rows.join(F.broadcast(keys), F.col(key) == F.col("hot_key"))
    least = own.groupBy("hot_key").agg(F.min(POSITION).alias("first_pos"))
    ids = rows.select(F.col(POSITION).alias("first_pos"), F.col("id").alias("first_id"))
    return ids.join(F.broadcast(least), "first_pos").select("hot_key", "first_pos", "first_id")


def flag_duplicates(keyed: DataFrame, key: str = "full_key", settled: bool = False) -> DataFrame:
    """Add ``duplicate_of``: the id first seen under the key, null for that first record.

    Rows are kept, never dropped. They are stored first, unless they are ``settled``: a stored
    table with its ingest positions. Rows of the hot keys then find their first record in a
    broadcast, without a shuffle; the others are dealt out by key once, where a window over the
    position finds it.
    """
    rows = keyed if settled else stored(keyed, "keyed")
    if POSITION not in rows.columns:
        rows = numbered(rows)
    columns = [F.col(c) for c in rows.columns]
    hot = stored(hot_keys(rows, key), "hot-keys")
    if hot.isEmpty():
        return _flagged_by_window(rows, key)
    hot = stored(first_of(rows, hot, key), "hot-firsts")
    matched = rows.join(F.broadcast(hot), F.col(key) == F.col("hot_key"))
    in_hot = matched.select(*columns, F.when(F.col(POSITION) != F.col("first_pos"), F.col("first_id")).alias("duplicate_of"))
    rest = rows.join(F.broadcast(hot.select("hot_key")), F.col(key) == F.col("hot_key"), "left_anti")
    return in_hot.unionByName(_flagged_by_window(rest, key))


def _flagged_by_window(rows: DataFrame, key: str) -> DataFrame:
    seen = Window.partitionBy(key).orderBy(POSITION)
    first = rows.withColumns({"first_pos": F.first(POSITION).over(seen), "first_id": F.first("id").over(seen)})
    flag = F.when(F.col(POSITION) != F.col("first_pos"), F.col("first_id")).alias("duplicate_of")
    return first.select(*(F.col(c) for c in rows.columns), flag)
