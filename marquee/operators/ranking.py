"""Ranks and row-based moving windows inside groups of any size, as one lazy plan.

A window partitioned by day, week or genre sends the whole group to one task,
and one day may hold a third of the data. Here a group is cut by the order
itself: `coarse` maps a value to a step of a logarithmic scale that keeps the
order. Small tables of counts per group and step give every step its start, and
only the rows of one step meet in a window. Ties are combined before they are
ranked, so a value that most rows share is one row. Nothing runs while the plan
is built, and it is the same plan at every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampType

Order = list[tuple[str, str]]

# Steps of the scale between a number and its double.
STEPS = 256
# Rows of one group that a moving window handles in one task.
CHUNK_ROWS = 1_000_000


def coarse(df: DataFrame, name: str) -> Column:
    """Step of a value on a scale that keeps the order: as many steps for each doubling, up and down from zero."""
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(kind, TimestampType):
        return F.unix_seconds(value).cast("bigint")
    if not isinstance(kind, NumericType):
        return F.ascii(value).cast("bigint")
    number = value.cast("double")
    size = F.greatest(F.abs(number), F.lit(1e-300))
    double = F.floor(F.log2(size))
    step = (double + 1000) * STEPS + F.floor((size / F.pow(F.lit(2.0), double) - 1) * STEPS)
    far = F.lit(1 << 40).cast("bigint")
    ends = F.when(F.isnan(number), far + 1).when(F.abs(number) == float("inf"), far).otherwise(step.cast("bigint"))
    step = F.when(number == 0, F.lit(0).cast("bigint")).when(number < 0, -ends).otherwise(ends)
    return F.when(value.isNotNull(), step)


def _sorting(order: Order) -> list[Column]:
    return [F.col(name).desc() if way == "desc" else F.col(name).asc() for name, way in order]


def _started(counts: DataFrame, keys: list[str], order: list[Column], measure: str, out: str) -> DataFrame:
    """Sum of `measure` over the rows that come earlier within `keys`."""
    earlier = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum(measure).over(earlier), F.lit(0).cast("bigint")))


def _with_step(df: DataFrame, order: Order) -> DataFrame:
    return df.withColumn("_step", coarse(df, order[0][0]))


def group_rank(df: DataFrame, by: list[str], order: Order, kind: str, out: str, top: int | None = None) -> DataFrame:
    """Add `dense_rank`, `rank` or `row_number` within `by`, as a bigint; `top` keeps the rows up to that rank.

    For `row_number` the order must tell rows apart, or the numbering of tied
    rows is arbitrary, as in any window.
    """
    if kind == "row_number":
        numbered = _numbered(df, by, order, out)
        return numbered if top is None else numbered.filter(F.col(out) <= top)
    ranks = value_ranks(df, by, order, kind, top)
    return with_ranks(df, ranks, by, order, out)


def value_ranks(df: DataFrame, by: list[str], order: Order, kind: str, top: int | None = None) -> DataFrame:
    """The rank of every value within `by`: one row for each, however many rows share it."""
    names = [name for name, _ in order]
    # Key columns as one struct: never null itself, so rows with null keys join by plain equality.
    values = df.groupBy(F.struct(*by).alias("_group"), F.struct(*names).alias("_value")).agg(F.count("*").alias("_rows"))
    values = _with_step(values.select("*", "_value.*"), order)
    counted = "_rows" if kind == "rank" else "_values"
    steps = values.groupBy("_group", "_step").agg(F.sum("_rows").alias("_rows"), F.count("*").alias("_values"))
    way = F.col("_step").desc() if order[0][1] == "desc" else F.col("_step").asc()
    starts = _started(steps, ["_group"], [way], counted, "_start")
    starts = starts.select("_group", F.struct("_step").alias("_at"), "_start")
    placed = values.withColumn("_at", F.struct("_step")).join(starts, ["_group", "_at"])
    one = placed.withColumn("_values", F.lit(1).cast("bigint"))
    ranked = _started(one, ["_group", "_at"], _sorting(order), counted, "_inside")
    ranks = ranked.select("_group", "_value", (F.col("_start") + F.col("_inside") + 1).alias("_rank"))
    # Cut before the rows are met again: only those of leading values are kept, however many share one.
    return ranks if top is None else ranks.filter(F.col("_rank") <= top)


def with_ranks(df: DataFrame, ranks: DataFrame, by: list[str], order: Order, out: str) -> DataFrame:
    """Rows with the rank of their value; rows whose value has none are left out."""
    keyed = df.withColumns({"_group": F.struct(*by), "_value": F.struct(*[name for name, _ in order])})
    return keyed.join(ranks, ["_group", "_value"]).select(*df.columns, F.col("_rank").alias(out))


def _numbered(df: DataFrame, by: list[str], order: Order, out: str) -> DataFrame:
    """Row numbers within `by`: cells of a step, a value and a step of the next column, each numbered by itself."""
    first, way = order[0]
    cells, turn = {"_group": F.struct(*by)}, {}
    if not isinstance(df.schema[first].dataType, DateType):  # a day is a step of its own
        cells["_step"], turn["_step"] = F.struct(coarse(df, first).alias("s")), way
    cells["_value"], turn["_value"] = F.struct(F.col(first).alias("v")), way
    if len(order) > 1:
        cells["_next"], turn["_next"] = F.struct(coarse(df, order[1][0]).alias("s")), order[1][1]
    keyed = df.withColumns(cells)
    levels = list(turn)
    counts = {len(levels): keyed.groupBy("_group", *levels).agg(F.count("*").alias("_rows"))}
    for depth in range(len(levels) - 1, 0, -1):
        counts[depth] = counts[depth + 1].groupBy("_group", *levels[:depth]).agg(F.sum("_rows").alias("_rows"))
    starts = None
    for depth in range(1, len(levels) + 1):
        level, keys = levels[depth - 1], ["_group", *levels[: depth - 1]]
        # The order of a struct of one field is that of the field.
        how = F.col(level).desc() if turn[level] == "desc" else F.col(level).asc()
        own = _started(counts[depth], keys, [how], "_rows", f"_from{depth}").drop("_rows")
        starts = own if starts is None else own.join(starts, keys)
    total = sum((F.col(f"_from{d}") for d in range(1, len(levels) + 1)), F.lit(0).cast("bigint"))
    cell = ["_group", *levels]
    inside = Window.partitionBy(*cell).orderBy(*_sorting(order))
    joined = keyed.join(starts.select(*cell, total.alias("_from")), cell)
    return joined.withColumn("_place", F.row_number().over(inside)).select(*df.columns, (F.col("_from") + F.col("_place")).alias(out))


def moving_rows(
    df: DataFrame, by: list[str], order: Order, back: int, measures: dict[str, Column], chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Aggregates over each row and the `back` rows before it in its group.

    The rows are numbered, cut into chunks of equal length, and the last `back`
    rows of a chunk are lent to the next one.
    """
    if back >= chunk_rows:
        raise ValueError("a chunk must be longer than the frame")
    numbered = _numbered(df, by, order, "_number")
    home = F.floor((F.col("_number") - 1) / chunk_rows)
    lent = (F.col("_number") - 1) % chunk_rows >= chunk_rows - back
    chunks = F.when(lent, F.array(home, home + 1)).otherwise(F.array(home))
    placed = numbered.withColumn("_home", home).withColumn("_chunk", F.explode(chunks))
    frame = Window.partitionBy(*by, "_chunk").orderBy("_number").rowsBetween(-back, Window.currentRow)
    measured = placed.withColumns({name: measure.over(frame) for name, measure in measures.items()})
    return measured.filter(F.col("_home") == F.col("_chunk")).drop("_number", "_home", "_chunk")
