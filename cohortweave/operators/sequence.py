"""Running totals and fills inside groups of any size.

A plain window sorts a whole group in one task. Here the input is staged once; a bounded sample of it
shows which groups are large and where their order would have to be cut for parts of equal size.
Only those groups are cut: totals per part (as many rows as parts) are accumulated by a window, what a part inherits
from its neighbours joins its rows as one extra row, and rows are only ever sorted inside their part. The
result equals the plain window; rows are shuffled once, whatever the numbers and ids in the order look like.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortweave.sources.store import cut_lineage

#: Inputs of so many rows at most are not cut (a tenth of it, where all rows are one group).
SPLIT_ABOVE = 500_000
#: Sampled rows a part (their number, narrow rows on the driver, is bounded by it), and the most parts.
SAMPLED, PARTS_MOST = 20, 4096
#: Rows that a task sorts, about: with more rows there are more tasks, not larger ones.
TASK_ROWS = 500_000

# Where a row stands in its part: what earlier parts hand over, the rows, what later parts hand back.
_HEAD, _BODY, _TAIL = 0, 1, 2


def nulls_last(col: Column) -> list[Column]:
    return [col.isNull(), col]


def _place(row: Sequence) -> tuple:
    """A sort key with nulls first, as Spark orders."""
    return tuple((x is not None, x) for x in row)


def _cuts(body: DataFrame, n: int, keys: Sequence[str], places: Sequence[str], parts: int) -> tuple[list[tuple], list[tuple]]:
    """Keys of large groups, and order values that cut the rows of these groups into ``parts`` of about one size."""
    own = [*keys, *places]
    share = int(min(1.0, SAMPLED * parts / n) * (1 << 30))
    sample = [tuple(r) for r in body.where(F.pmod(F.xxhash64(*own), F.lit(1 << 30)) <= share)
              .select(*own).limit(2 * SAMPLED * parts).collect()]
    often = Counter(r[:len(keys)] for r in sample)
    large = [k for k, times in often.items() if 2 * times >= SAMPLED]
    known = set(large)
    values = sorted((r[len(keys):] for r in sample if r[:len(keys)] in known), key=_place)
    picked = [values[i * len(values) // parts] for i in range(1, parts)] if values else []
    return large, list(dict.fromkeys(picked))


def _structs(df: DataFrame, columns: Sequence[str], rows: Sequence[tuple]) -> list[Column]:
    kinds = [df.schema[c].dataType for c in columns]
    return [F.struct(*[F.lit(x).cast(k).alias(c) for x, k, c in zip(row, kinds, columns)]) for row in rows]


def _part(df: DataFrame, keys: Sequence[str], places: Sequence[str], large: list[tuple], cuts: list[tuple]) -> Column:
    """The number of a row's part: how many cuts lie at or before it (a binary search), 0 outside large groups."""
    at, bounds = F.struct(*[F.col(p).alias(p) for p in places]), _structs(df, places, cuts)

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(at < bounds[middle], search(low, middle)).otherwise(search(middle + 1, high))

    found = search(0, len(bounds))
    if not keys:
        return found
    own = F.struct(*[F.col(k).alias(k) for k in keys])
    return F.when(F.array_contains(F.array(*_structs(df, keys, large)), own), found).otherwise(F.lit(0))


def sequence_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    before: Mapping[str, Column] | None = None,
    fills: Mapping[str, Column] | None = None,
    split_above: int | None = None,
    parts: int | None = None,
    together: Sequence[str] | None = None,
) -> DataFrame:
    """Add columns computed over each group in ``order`` (ascending, nulls first; it should tell the rows of a group apart).

    ``before``: name -> weight; the sum of the weights of all earlier rows of the group
    (weight 1 gives the 0-based row number).
    ``fills``: name -> value; the value itself, else the nearest earlier non-null one,
    else the nearest later one.
    Null keys form a group like any other. ``df`` is evaluated once, into a staged table.
    ``together``: some of the keys; unless a group is large, rows alike in these lie in one task, so that
    groupings by these and other columns that follow move no rows.
    """
    before, fills = before or {}, fills or {}
    weight, value = {n: f"_w_{n}" for n in before}, {n: f"_v_{n}" for n in fills}
    places = [f"_o{i}" for i in range(len(order))]
    body = cut_lineage(df.select(
        "*", *[(F.col(o) if isinstance(o, str) else o).alias(p) for o, p in zip(order, places)],
        *[w.cast("bigint").alias(weight[n]) for n, w in before.items()],
        *[v.alias(value[n]) for n, v in fills.items()]))
    kept = [c for c in df.columns if c not in {*before, *fills}]
    n = body.count()  # from the staged files' footers
    large, cuts = [], []
    if split_above is None:
        split_above = SPLIT_ABOVE if keys else SPLIT_ABOVE // 10
    if n > split_above:
        parts = parts or min(PARTS_MOST, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        large, cuts = _cuts(body, n, keys, places, parts)
    tasks = 0
    if n > TASK_ROWS:
        tasks = max(math.ceil(n / TASK_ROWS), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if not cuts:
        return _numbered(_dealt(body, tasks, together, keys), keys, places, kept, weight, value)

    body = body.withColumn("_part", _part(body, keys, places, large, cuts)).withColumn("_at", F.lit(_BODY))
    cell = [*keys, "_part"]
    rank = F.struct(*places)
    split = body
    if keys:
        own = F.struct(*[F.col(k).alias(k) for k in keys])
        split = body.where(F.array_contains(F.array(*_structs(body, keys, large)), own))
    totals = split.groupBy(*cell).agg(
        *[F.sum(w).alias(w) for w in weight.values()],
        *[a for v in value.values() for a in (
            F.max_by(v, F.when(F.col(v).isNotNull(), rank)).alias(f"{v}_last"),
            F.min_by(v, F.when(F.col(v).isNotNull(), rank)).alias(f"{v}_first"),
        )])
    # Backward looks use a descending window: a frame that follows the row to the end of
    # the partition would be recomputed for every row.
    ahead = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy(*keys).orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    handed = totals.select(
        *cell, *[F.sum(w).over(ahead).alias(w) for w in weight.values()],
        *[F.last(f"{v}_last", ignorenulls=True).over(ahead).alias(f"{v}_last") for v in value.values()],
        *[F.last(f"{v}_first", ignorenulls=True).over(behind).alias(f"{v}_first") for v in value.values()])

    def extra(at: int, columns: dict[str, str]) -> DataFrame:
        some = reduce(or_, [F.col(c).isNotNull() for c in columns.values()])
        return handed.where(some).select(
            *cell, *[F.col(c).alias(n) for n, c in columns.items()], F.lit(at).alias("_at"))

    head = {w: w for w in weight.values()} | {v: f"{v}_last" for v in value.values()}
    rows = body.unionByName(extra(_HEAD, head), allowMissingColumns=True)
    if value:
        rows = rows.unionByName(
            extra(_TAIL, {v: f"{v}_first" for v in value.values()}), allowMissingColumns=True)
    done = _numbered(_dealt(rows, tasks, None, cell), cell, ["_at", *places], [*kept, "_at"], weight, value)
    return done.where(F.col("_at") == _BODY).drop("_at")


def _dealt(rows: DataFrame, tasks: int, together: Sequence[str] | None, cell: Sequence[str]) -> DataFrame:
    """``rows`` by ``together`` (null: by cell) in so many tasks; with 0, as many as the session says."""
    if tasks and cell:
        return rows.repartition(tasks, *(together or cell))
    return rows.repartition(*together) if together else rows


def _numbered(rows: DataFrame, cell: Sequence[str], order: Sequence[str], kept: Sequence[str],
              weight: Mapping[str, str], value: Mapping[str, str]) -> DataFrame:
    """The plain windows, inside each cell."""
    inside = Window.partitionBy(*cell)
    forward, backward = inside.orderBy(*order), inside.orderBy(*[F.desc(o) for o in order])
    earlier = forward.rowsBetween(Window.unboundedPreceding, -1)
    so_far = forward.rowsBetween(Window.unboundedPreceding, 0)
    from_end = backward.rowsBetween(Window.unboundedPreceding, 0)
    return rows.select(
        *kept,
        *[F.coalesce(F.sum(w).over(earlier), F.lit(0)).alias(n) for n, w in weight.items()],
        *[F.coalesce(F.last(v, ignorenulls=True).over(so_far),
                     F.last(v, ignorenulls=True).over(from_end)).alias(n) for n, v in value.items()])
