"""Equi joins that stay balanced when some keys carry a large share of the rows.

A right side that reads little needs no care: Spark checks its size, before or
during the run, and broadcasts it or not; no hint forces it. Beyond that limit
the join shuffles, and a hot key would send all its rows to one task.
``balanced_join`` then spreads every such key over several salts. Which keys are hot is
found without shuffling keys; the answer is stored once per table and key and read by both
sides of every join that needs it, so every left row meets every matching right row exactly
once. Both ways give the same rows and types: keys are brought to one type first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.session import work_folder
from terrace.sources.tables import materialise

# A key is hot when one task would get more rows of it than this.
ROWS_PER_TASK = 2_000_000

_JOINS = ("left", "inner", "left_semi", "left_anti")


def input_bytes(df: DataFrame) -> int | None:
    """Size of everything ``df`` reads, as the optimizer sees it.

    The estimate for a whole plan multiplies both sides of every join, which makes
    any chain of lookups look enormous; the sum of the inputs does not. None where
    the session does not expose the plan.
    """
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    leaves = plan.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def broadcast_limit(df: DataFrame) -> int:
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    text = text.strip().lower().removesuffix("b")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(text[-1:], 1)
    return int(text if scale == 1 else text[:-1]) * scale


def is_small(df: DataFrame) -> bool:
    size = input_bytes(df)
    return size is not None and size <= broadcast_limit(df)


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "left",
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """``left.join(right, on, how)`` for left, inner, left_semi and left_anti.

    Where ``left`` is itself the result of joins or aggregates, pass the table its
    key columns came from as ``keys_from``: looking for hot keys there is one scan
    of those columns instead of a second run of everything below ``left``.
    """
    if how not in _JOINS:
        raise ValueError(f"cannot salt a {how} join")
    # Few rows hold no hot key. Only a stored holder of the keys is counted for that: its files know.
    if is_small(right) or (keys_from is not None and keys_from.count() <= ROWS_PER_TASK):
        left, right, _ = _aligned(left, right, [on] if isinstance(on, str) else list(on))
        return left.join(right, on, how)
    return salted_join(left, right, on, how, keys_from=keys_from)


def _aligned(
    left: DataFrame, right: DataFrame, keys: list[str], others: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Both sides (and another holder of the keys) with the keys in their common type.

    Types without one are refused by Spark's own rules for unions.
    """
    frames = [f for f in (left, right, others) if f is not None]
    types = {
        k: reduce(DataFrame.union, [f.select(k) for f in frames]).schema[0].dataType
        for k in keys if len({f.schema[k].dataType for f in frames}) > 1
    }
    cast = {k: F.col(k).cast(kind) for k, kind in types.items()}
    fitted = [f.withColumns(cast) if cast else f for f in frames]
    return fitted[0], fitted[1], fitted[2] if others is not None else None


# A summary tracks at most so many keys: the engine's own limit for its sketch of frequent items.
_MOST_TRACKED = 1_000_000
# The sketch is off by at most 3.5 rows in (counters kept) rows, and reports a key only above twice that.
_COUNTERS_PER_KEY = 8
# Summaries of single tasks meet in so many groups before they meet in one.
_GROUPS = 64


def hot_keys(df: DataFrame, keys: list[str], rows_per_task: int | None = None) -> DataFrame:
    """(keys, salts) of all keys too heavy for one task, null keys among them.

    Rows are not counted per key. Every task keeps a bounded summary of the most frequent keys
    (mergeable, after Misra and Gries), summaries are merged, and only the few candidates that the
    merged one names are counted exactly, in a second scan of the key columns. The summary has
    ``_COUNTERS_PER_KEY`` counters for each key that can exceed the limit, so its error stays below
    the limit and it names them all; candidates below the limit drop out in the count. A table
    that could hold more hot keys than a summary tracks is searched with a higher limit instead:
    its largest keys still stand for no more than 8 rows in a million.
    """
    limit = rows_per_task or ROWS_PER_TASK
    rows = df.count()
    tracked = min(_MOST_TRACKED, max(64, -(-_COUNTERS_PER_KEY * rows // limit)))
    limit = max(limit, -(-_COUNTERS_PER_KEY * rows // _MOST_TRACKED))
    hashed = df.select(*keys, F.xxhash64(*keys).alias("_hash"))
    none = df.select(*keys, F.lit(0).alias("_salts")).limit(0)
    if rows <= limit:
        return none
    grouped = hashed.groupBy((F.spark_partition_id() % _GROUPS).alias("_group")).agg(
        F.expr(f"approx_top_k_accumulate(_hash, {tracked})").alias("_summary")
    )
    # Grouped, by a column that is the same everywhere: an empty partition has no summary to merge.
    merged = grouped.groupBy((F.col("_group") * 0).alias("_all")).agg(
        F.expr(f"approx_top_k_combine(_summary, {tracked})").alias("_summary")
    )
    named = materialise(
        merged.select(F.explode(F.expr(f"approx_top_k_estimate(_summary, {tracked})")).alias("_top")).select("_top.item"), "candidates"
    )
    # At most ``tracked`` hashes of 8 bytes, by the sketch's own bound.
    met = hashed.join(F.broadcast(named), hashed["_hash"] == named["item"], "left_semi")
    counted = met.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    salts = F.ceil(F.col("_n") / F.lit(limit)).cast("int")
    return counted.select(*keys, salts.alias("_salts")).filter("_salts > 1")


# Hot keys found before, by work folder, plan and keys: one search per table and key, shared by all joins.
_FOUND: dict[tuple, list[tuple[DataFrame, DataFrame]]] = {}


def known_hot_keys(df: DataFrame, keys: list[str], rows_per_task: int | None = None) -> DataFrame:
    """``hot_keys``, stored; a table that was searched for the same keys before is not searched again."""
    searched = df.select(*keys)
    place = (work_folder(df.sparkSession), searched.semanticHash(), tuple(keys), rows_per_task or ROWS_PER_TASK)
    for known, answer in _FOUND.get(place, []):
        if known.sameSemantics(searched):
            return answer
    answer = materialise(hot_keys(searched, keys, rows_per_task), "hot-keys")
    _FOUND.setdefault(place, []).append((searched, answer))
    return answer


def _met(left: str, right: str, keys: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "left",
    rows_per_task: int | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Spread hot left keys over salts and repeat only their right rows.

    The salt comes from a hash of the whole left row, so a recomputed task places its
    rows as the lost one did. Hot keys are stored, not hinted: Spark broadcasts them or
    not by their true size. Null keys match nothing; they are only spread.
    """
    if how not in _JOINS:
        raise ValueError(f"cannot salt a {how} join")
    keys = [on] if isinstance(on, str) else list(on)
    left, right, counted = _aligned(left, right, keys, keys_from)
    hot = known_hot_keys(left if counted is None else counted, keys, rows_per_task)

    row_hash = F.xxhash64(*[F.col(f"l.`{c}`") for c in left.columns])
    spread = left.alias("l").join(hot.alias("h"), _met("l", "h", keys), "left").select(
        "l.*", F.coalesce(F.pmod(row_hash, F.col("h._salts")), F.lit(0)).cast("int").alias("_salt")
    )
    repeated = right.alias("r").join(hot.alias("h"), _met("r", "h", keys), "left").select(
        "r.*", F.explode(F.sequence(F.lit(0), F.coalesce("h._salts", F.lit(1)) - 1)).alias("_salt")
    )
    return spread.join(repeated, [*keys, "_salt"], how).drop("_salt")
