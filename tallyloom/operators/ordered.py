"""Running values over long ordered groups, without one task per group, and sums that do not depend on order.

Rows are dealt into ranges of (group, order) that hold about equally many rows, whatever the order column is and
however sparse its values are. Windows run inside a range; what the earlier ranges of a group contribute comes
from one summary row per (range, group), combined over teams of ranges first. A group that holds a third of
the table is thus spread over a third of the ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.sources.workspace import stage

# Rows of a task and of a range, and ranges whose summaries are combined before all are.
CHUNK, TEAM = 100_000, 1000
# Bits of a row's place in its task, as ``monotonically_increasing_id`` has them.
PLACE_BITS = 33
# Exponents of the bins of a sum: multiples of 2**k below 2**32 of them. All bits of numbers from 2**-43 to 2**62 fall into them.
BINS = (32, 0, -32, -64, -96)
HUGE = 2.0**62


def whole_part(column: str, size: int) -> Column:
    """Whole-number quotient of a whole-number column; exact for any bigint."""
    return F.expr(f"`{column}` div {int(size)}")


def group_key(by: Sequence[str]) -> Column:
    """The group columns as one value that is never null, so that joins keep groups named null."""
    return F.struct(*by)


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join on group columns in which null is a group like any other."""
    keyed = left.withColumn("_group", group_key(keys))
    return keyed.join(right.withColumn("_group", group_key(keys)).drop(*keys), "_group").drop("_group")


def running_before(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    kind: str,
    value: Column | str,
    name: str,
    chunk: int = CHUNK,
) -> DataFrame:
    """Add ``name``: sum, max or last non-null of ``value`` over the earlier rows of the group.

    ``order`` is a column of any sortable type, unique within the group. About ``chunk`` rows are handled
    together. Ranges of fewer than ``CHUNK`` rows share a task, so tasks grow with the rows and not with the ranges. Without
    earlier rows the result is null.
    """
    value = F.col(value) if isinstance(value, str) else value
    rows = df.withColumn("_value", value)
    rows = rows.repartitionByRange(rows.count() // max(chunk, CHUNK) + 1, *by, order)
    if chunk >= CHUNK:
        rows = rows.withColumn("_range", F.spark_partition_id())
    else:
        rows = rows.sortWithinPartitions(*by, order).withColumn("_place", F.monotonically_increasing_id())
        place, most = F.expr(f"(_place & {2**PLACE_BITS - 1}) div {chunk}"), 2**PLACE_BITS // chunk + 1
        rows = rows.withColumn("_range", F.shiftright("_place", PLACE_BITS) * F.lit(most) + place).drop("_place")
    # Written once: ranges keep their rows if a task is repeated.
    rows = stage(rows, "ranges").withColumn("_part", group_key([*by, "_range"]))
    earlier = (Window.unboundedPreceding, -1)
    in_range = Window.partitionBy("_part").orderBy(order).rowsBetween(*earlier)
    known = F.col("_value").isNotNull()
    summary, over, local, both = {
        "sum": (
            F.sum("_value"),
            F.sum,
            F.sum("_value"),
            lambda a, b: F.when(a.isNull() & b.isNull(), None).otherwise(
                F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
            ),
        ),
        "max": (F.max("_value"), F.max, F.max("_value"), F.greatest),
        "last": (
            F.max_by("_value", F.when(known, F.col(order))),
            lambda column: F.last(column, ignorenulls=True),
            F.last("_value", ignorenulls=True),
            F.coalesce,
        ),
    }[kind]
    summaries = rows.groupBy("_part").agg(summary.alias("_summary"))
    carried = _carried(summaries, by, over, both)
    return (
        rows.withColumn("_local", local.over(in_range))
        .join(carried, "_part")
        .select(*df.columns, both(F.col("_local"), F.col("_carried")).alias(name))
    )


def _carried(summaries: DataFrame, by: Sequence[str], over, both) -> DataFrame:
    """``_part, _carried``: what the earlier ranges of each range's group add up to.

    A window holds the ranges of one team at most, and the teams of one group: a thousandth of its ranges, or a few for each of its
    tasks where these hold fewer ranges.
    """
    group = F.struct(*[F.col(f"_part.{column}") for column in by])
    placed = summaries.withColumns({"_group": group, "_range": F.col("_part._range"), "_team": F.floor(F.col("_part._range") / TEAM)})
    team = Window.partitionBy("_group", "_team").orderBy("_range")
    before = team.rowsBetween(Window.unboundedPreceding, -1)
    upto = team.rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.withColumns({"_inside": over("_summary").over(before), "_sofar": over("_summary").over(upto)})
    ends = inside.groupBy("_group", "_team").agg(F.max_by("_sofar", "_range").alias("_whole"))
    earlier = Window.partitionBy("_group").orderBy("_team").rowsBetween(Window.unboundedPreceding, -1)
    teams = ends.select("_group", "_team", over("_whole").over(earlier).alias("_base"))
    return inside.join(teams, ["_group", "_team"]).select("_part", both(F.col("_inside"), F.col("_base")).alias("_carried"))


def exact_sum(value: Column | str) -> Column:
    """Sum of doubles that does not depend on the order of the rows, for up to 2**31 finite rows of a group.

    Every number is split into whole multiples of the powers of two in ``BINS``; the multiples are added as whole numbers, which
    combine on the map side, and the few totals are added from the smallest power up. What lies below the last bin is
    cut off row by row. Numbers from ``HUGE`` on are added as they are.
    """
    value = (F.col(value) if isinstance(value, str) else value).cast("double")
    huge = F.abs(value) >= HUGE
    usual, totals = F.when(~huge, value), []
    for above, exponent in zip((None, *BINS), BINS):
        # The remainder and the quotient by a power of two are exact.
        rest = usual if above is None else usual % F.lit(2.0**above)
        totals.append(F.sum((rest / F.lit(2.0**exponent)).cast("bigint")).cast("double") * F.lit(2.0**exponent))
    added = F.coalesce(totals[-1], F.lit(0.0))
    for total in reversed(totals[:-1]):
        added = added + F.coalesce(total, F.lit(0.0))
    return F.when(F.count(value) > 0, added + F.coalesce(F.sum(F.when(huge, value)), F.lit(0.0)))
