"""Numbering, ranking and frames over an order, without one task per group.

A plain window moves each group, or the whole table when there is none, into one task.
Here the rows are range-partitioned by group, order and a unique last key, so that a
large group covers many partitions, and numbered from partition counts. All frames then
work on blocks of consecutive rows, and the totals of earlier blocks are carried over. Building
such a plan writes the ordered rows once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import percent, ratio
from ..session import materialize, small_side
from .grouping import with_total
from .joins import null_safe
from .sorting import sort_keys

BLOCK_ROWS = 1 << 18
_ALL_BEFORE = (Window.unboundedPreceding, -1)
_TO_CURRENT = (Window.unboundedPreceding, Window.currentRow)
# calculations over all earlier rows: aggregate and frame
_TOTALS = {
    "position": (F.count, _TO_CURRENT),
    "running_sum": (F.sum, _TO_CURRENT),
    "largest_before": (F.max, _ALL_BEFORE),
}


@dataclass(frozen=True)
class Frame:
    """One calculation over the ordered rows of a group."""

    kind: str
    column: str | None = None
    before: int = 0
    after: int = 0
    digits: int = 2


def position() -> Frame:
    """1, 2, 3, ...: the row number, and also the running count of rows."""
    return Frame("position")


def running_sum(column: str) -> Frame:
    return Frame("running_sum", column)


def largest_before(column: str) -> Frame:
    """Largest value of the rows before the current one; NULL on the first row."""
    return Frame("largest_before", column)


def previous(column: str, steps: int = 1) -> Frame:
    return Frame("previous", column, before=steps)


def following(column: str, steps: int = 1) -> Frame:
    return Frame("following", column, after=steps)


def moving_mean(column: str, before: int, after: int, digits: int = 2) -> Frame:
    return Frame("moving_mean", column, before, after, digits)


def _shift(frame: Frame, window) -> Column:
    if frame.kind == "previous":
        return F.lag(frame.column, frame.before).over(window)
    if frame.kind == "following":
        return F.lead(frame.column, frame.after).over(window)
    near = window.rowsBetween(-frame.before, frame.after)
    total, count = F.sum(frame.column).over(near), F.count(frame.column).over(near)
    return ratio(total, count, frame.digits)


def _positions(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Add ``_at``, the place of each row in the whole order, from 0.

    The range-partitioned rows are written once with their partition number and place, so
    that all readers see the same layout. The partition counts are one row per partition,
    few enough to be broadcast.
    """
    stored = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id()),
        "ordered",
    )
    slices = stored.groupBy("_slice").agg(
        F.min("_place").alias("_first"), F.count("*").alias("_rows")
    )
    earlier = Window.orderBy("_slice").rowsBetween(*_ALL_BEFORE)
    starts = slices.select(
        "_slice", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_start")
    )
    return stored.join(F.broadcast(starts), "_slice").select(
        *df.columns, (F.col("_place") + F.col("_start")).alias("_at")
    )


def number_rows(df: DataFrame, order_by: Sequence[str], name: str = "row_num") -> DataFrame:
    """Number the rows 1, 2, 3, ... in order; ``order_by`` must end with a unique key."""
    placed = _positions(df, sort_keys(order_by))
    return placed.select(*df.columns, (F.col("_at") + 1).alias(name))


def over_order(
    df: DataFrame,
    order_by: Sequence[str],
    frames: Mapping[str, Frame],
    partition_by: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add calculations over the ordered rows (per group); ``order_by`` must end with a unique key."""
    before = max(f.before for f in frames.values())
    after = max(f.after for f in frames.values())
    block_rows = max(block_rows, before, after)  # edge rows come from the next block only
    keys = list(partition_by)
    order = [F.col(k).asc_nulls_last() for k in keys] + sort_keys(order_by)
    placed = _positions(df, order).withColumn("_block", F.floor(F.col("_at") / block_rows))
    blocks = [*keys, "_block"]

    rows = placed
    if before or after:
        # copy the edge rows of each block into its neighbours
        place = F.col("_at") % block_rows
        targets = F.array(
            F.col("_block"),
            F.when(place < after, F.col("_block") - 1),
            F.when(place >= block_rows - before, F.col("_block") + 1),
        )
        rows = (
            rows.withColumn("_own", F.col("_block"))
            .withColumn("_block", F.explode(F.filter(targets, lambda b: b >= 0)))
            .withColumn("_home", F.col("_own") == F.col("_block"))
            .drop("_own")
        )
    else:
        rows = rows.withColumn("_home", F.lit(True))

    made: dict[str, Column] = {}
    window = Window.partitionBy(*blocks).orderBy("_at")
    for name, frame in frames.items():
        if frame.kind in _TOTALS:
            total, reach = _TOTALS[frame.kind]
            value = F.lit(1) if frame.column is None else F.col(frame.column)
            made[name] = total(F.when(F.col("_home"), value)).over(window.rowsBetween(*reach))
        else:
            made[name] = _shift(frame, window)
    result = rows.withColumns(made).where("_home")

    running = {n: f for n, f in frames.items() if f.kind in _TOTALS}
    if running:
        result = _carry_over(result, placed, running, keys, block_rows)
    return result.select(*df.columns, *frames)


def _carry_over(
    result: DataFrame,
    placed: DataFrame,
    running: Mapping[str, Frame],
    keys: Sequence[str],
    block_rows: int,
) -> DataFrame:
    """Add to each block the totals of the earlier blocks of its group.

    Only a group that holds the first row of a later block can reach over a border, so no
    more groups than blocks are totalled.
    """
    spanning = placed
    if keys:
        first_rows = placed.where((F.col("_at") % block_rows == 0) & (F.col("_block") > 0))
        spanning = null_safe(placed, small_side(first_rows.select(*keys).distinct()), keys, "left_semi")
    blocks = [*keys, "_block"]
    per_block = spanning.groupBy(*blocks).agg(
        *[
            _TOTALS[f.kind][0](F.lit(1) if f.column is None else F.col(f.column)).alias(f"_of_{n}")
            for n, f in running.items()
        ]
    )
    merge = {n: F.max if f.kind == "largest_before" else F.sum for n, f in running.items()}
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(*_ALL_BEFORE)
    carried = per_block.select(
        *blocks, *[merge[n](f"_of_{n}").over(earlier).alias(f"_in_{n}") for n in running]
    )
    result = null_safe(result, small_side(carried), blocks, "left")
    for name, frame in running.items():
        here, carry = F.col(name), F.col(f"_in_{name}")
        if frame.kind == "largest_before":
            result = result.withColumn(name, F.greatest(here, carry))
        else:
            result = result.withColumn(name, F.coalesce(here + carry, here, carry))
    return result


def _runs_of(df: DataFrame, value: str, keys: Sequence[str], slices: int | None) -> DataFrame:
    """The rows in slices of the order by group and value, largest first, written once.

    Range partitions of the order, with a random last key that splits ties, are the slices. Added
    are, as places in the slice: ``_place``, ``_group`` and ``_run`` (where the row's group and its
    run of equal values begin there), ``_values`` (how many values of the group came so far in the
    slice) and ``_last`` (the slice ends here).
    """
    order = [F.col(k).asc_nulls_last() for k in keys] + [F.col(value).desc_nulls_first(), F.col("_tie").asc()]
    tied = df.withColumn("_tie", F.rand(17))
    ranged = tied.repartitionByRange(*order) if slices is None else tied.repartitionByRange(slices, *order)
    placed = ranged.sortWithinPartitions(*order).select(
        *df.columns,
        F.spark_partition_id().alias("_slice"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
    )
    here = Window.partitionBy("_slice").orderBy("_place")
    so_far = here.rowsBetween(*_TO_CURRENT)
    first = F.col("_place") == 0
    new_group, new_value = first, ~F.lag(value).over(here).eqNullSafe(F.col(value))
    for k in keys:
        new_group = new_group | ~F.lag(k).over(here).eqNullSafe(F.col(k))
    marked = placed.withColumns({"_g": new_group, "_v": new_group | new_value, "_last": F.lead("_place").over(here).isNull()})
    counted = marked.withColumns(
        {
            "_group": F.max(F.when(F.col("_g"), F.col("_place"))).over(so_far),
            "_run": F.max(F.when(F.col("_v"), F.col("_place"))).over(so_far),
            "_seen": F.count_if("_v").over(so_far),
        }
    )
    before = F.max(F.when(F.col("_g"), F.col("_seen"))).over(so_far)
    return materialize(counted.withColumn("_values", F.col("_seen") - before + 1).drop("_g", "_v", "_seen"), "ranked")


def _carried(runs: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """What the first group of each slice has in earlier ones: rows, values, rows of its first value.

    Read from the first and last row of every slice, two small rows per range partition.
    """
    firsts = runs.where("_place = 0").select("_slice", *[F.col(k).alias(f"_first_{k}") for k in keys], F.col(value).alias("_first_value"))
    lasts = runs.where("_last").select(
        "_slice",
        *[F.col(k).alias(f"_last_{k}") for k in keys],
        F.col(value).alias("_last_value"),
        (F.col("_place") - F.col("_group") + 1).alias("_tail"),
        (F.col("_place") - F.col("_run") + 1).alias("_same"),
        "_values",
        (F.col("_group") == 0).alias("_single"),
    )
    along = Window.orderBy("_slice")
    goes_on = F.lag("_slice").over(along).isNotNull()
    for k in keys:
        goes_on = goes_on & F.lag(f"_last_{k}").over(along).eqNullSafe(F.col(f"_first_{k}"))
    equal = goes_on & F.lag("_last_value").over(along).eqNullSafe(F.col("_first_value"))
    ends = firsts.join(lasts, "_slice").withColumns({"_goes_on": goes_on, "_equal": equal.cast("bigint")})
    # a value that goes on from the slice before is not counted again
    new_values = F.col("_values") - F.when(F.col("_single"), F.col("_equal")).otherwise(0)
    group = [f"_last_{k}" for k in keys]
    in_group = Window.partitionBy(*group).orderBy("_slice").rowsBetween(*_TO_CURRENT)
    in_value = Window.partitionBy(*group, "_last_value").orderBy("_slice").rowsBetween(*_TO_CURRENT)
    summed = ends.withColumns(
        {
            "_rows_to": F.sum("_tail").over(in_group),
            "_values_to": F.sum(new_values).over(in_group),
            "_same_to": F.sum("_same").over(in_value),
        }
    )

    def carried(name: str, condition: Column) -> Column:
        return F.when(condition, F.lag(name).over(along)).otherwise(0)

    return summed.select(
        "_slice",
        carried("_rows_to", F.col("_goes_on")).alias("_rows_before"),
        (carried("_values_to", F.col("_goes_on")) - F.col("_equal")).alias("_values_before"),
        carried("_same_to", F.col("_equal") == 1).alias("_same_before"),
    )


def rank_rows(
    df: DataFrame,
    value: str,
    names: Mapping[str, str],
    partition_by: Sequence[str] = (),
    share: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Add ranks by a value, largest first; ``names`` maps rank / dense_rank to a column.

    Rows get their ranks where they lie in the order: within a slice of it from the places where
    groups and values begin, and for the first group of a slice from the totals of the earlier
    ones. A hot group or value covers many slices; nothing is joined by value. ``share`` adds
    100 * value / sum of the group. ``slices`` sets the number of range partitions.
    """
    keys = list(partition_by)
    runs = _runs_of(df, value, keys, slices)
    rows = runs.join(F.broadcast(_carried(runs, value, keys)), "_slice")
    lead, run = F.col("_group") == 0, F.col("_run") == 0
    inside = F.col("_run") - F.col("_group") + 1
    made = {
        "rank": F.when(lead, F.col("_rows_before") + F.when(run, 1 - F.col("_same_before")).otherwise(inside)).otherwise(inside),
        "dense_rank": F.col("_values") + F.when(lead, F.col("_values_before")).otherwise(0),
    }
    columns = {n: made[kind].cast("bigint") for kind, n in names.items()}
    if share is not None:
        rows = with_total(rows, value, "_total", keys)
        columns[share] = percent(value, "_total")
    return rows.select(*df.columns, *[c.alias(n) for n, c in columns.items()])


def top_ranked(
    df: DataFrame,
    value: str,
    k: int,
    names: Mapping[str, str],
    partition_by: Sequence[str] = (),
    by: str = "dense_rank",
) -> DataFrame:
    """Rows whose rank by ``value`` (largest first) is at most ``k``, with their ranks.

    At most k distinct values per group can qualify, so only those are ranked: Catalyst cuts
    each task to k values per group before the shuffle. All tied rows are kept. Without
    groups the ranked values are k rows, so they can be broadcast as they are.
    """
    keys = list(partition_by)
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("_ties"))
    largest = F.col(value).desc_nulls_first()
    if not keys:
        counted = counted.orderBy(largest).limit(k)
    window = Window.partitionBy(*keys).orderBy(largest)
    best = counted.withColumn("_dense", F.row_number().over(window)).where(F.col("_dense") <= k)
    best = best.withColumn(
        "_rank",
        F.sum("_ties").over(Window.partitionBy(*keys).orderBy("_dense").rowsBetween(*_TO_CURRENT))
        - F.col("_ties")
        + 1,
    )
    if by == "rank":
        best = best.where(F.col("_rank") <= k)
    formula = {"dense_rank": "_dense", "rank": "_rank"}
    best = best.select(
        *keys, value, *[F.col(formula[kind]).cast("bigint").alias(n) for kind, n in names.items()]
    )
    best = small_side(best) if keys else F.broadcast(best)
    return null_safe(df, best, [*keys, value])


def assign_keys(
    df: DataFrame,
    order_by: Sequence[str],
    key: str,
    start: int | Column = 1,
) -> DataFrame:
    """Add consecutive surrogate keys from ``start`` in the given order."""
    numbered = over_order(df, order_by, {"_n": position()})
    first = F.lit(start) if isinstance(start, int) else start
    return numbered.withColumn(key, (first + F.col("_n") - 1).cast("bigint")).drop("_n")
