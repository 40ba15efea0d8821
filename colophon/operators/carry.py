"""Order-sensitive operators: values carried along lines, islands of equal lines, neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _over(part: list[str], order: list[str]):
    return Window.partitionBy(*part).orderBy(*order)


def carry_forward(df: DataFrame, value: Column, name: str, part: list[str], order: list[str], own: bool = True) -> DataFrame:
    """The last value at or before (``own``), or strictly before, each row; null values pass nothing on."""
    frame = _over(part, order).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(frame))


def look_ahead(df: DataFrame, value: Column, name: str, part: list[str], order: list[str]) -> DataFrame:
    """The first value strictly after each row."""
    return df.withColumn(name, F.first(value, ignorenulls=True).over(_over(part, order).rowsBetween(1, Window.unboundedFollowing)))


def two_level_carry(df: DataFrame, value: Column, name: str, part: list[str], page: list[str], order: list[str], chunk: Column | None = None) -> DataFrame:
    """``carry_forward`` over a whole part without sorting it in one task.

    The last value of each page is carried over the pages, and each page starts from what it is handed.  Where pages are many
    themselves, ``chunk`` (an expression of the page that does not fall as pages go on) adds a level between: pages are carried within chunks, and
    chunks within the part.  "The last value that is not null" is associative, so the result is that of one long scan.
    """
    marked = df.withColumn("_own", value)
    ends = marked.groupBy(*part, *page).agg(F.max_by("_own", F.when(F.col("_own").isNotNull(), F.struct(*order))).alias("_end"))
    if chunk is None:
        handed = carry_forward(ends, F.col("_end"), "_handed", part, page, own=False).drop("_end")
    else:
        ends = ends.withColumn("_chunk", chunk)
        last = ends.groupBy(*part, "_chunk").agg(F.max_by("_end", F.when(F.col("_end").isNotNull(), F.struct(*page))).alias("_last"))
        outer = carry_forward(last, F.col("_last"), "_outer", part, ["_chunk"], own=False).drop("_last")
        inner = carry_forward(ends, F.col("_end"), "_inner", [*part, "_chunk"], page, own=False).drop("_end")
        handed = inner.join(outer, [*part, "_chunk"], "left").withColumn("_handed", F.coalesce("_inner", "_outer")).drop("_inner", "_outer", "_chunk")
    local = carry_forward(marked, F.col("_own"), "_local", [*part, *page], order)
    return local.join(handed, [*part, *page], "left").withColumn(name, F.coalesce("_local", "_handed")).drop("_own", "_local", "_handed")


def islands(df: DataFrame, same: Column, name: str, part: list[str], order: list[str], never: Column | None = None) -> DataFrame:
    """Number the blocks of neighbouring rows with the same value; rows where ``never`` holds stand alone."""
    over = _over(part, order)
    turn = ~same.eqNullSafe(F.lag(same).over(over)) | F.lag(F.lit(1)).over(over).isNull()
    if never is not None:
        turn = turn | never | F.coalesce(F.lag(never).over(over), F.lit(False))
    return df.withColumn("_turn", turn.cast("int")).withColumn(name, F.sum("_turn").over(over.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_turn")


def trim_trailing(df: DataFrame, drop: Column, part: list[str], order: str) -> DataFrame:
    """Without the rows at the end of each part for which ``drop`` holds."""
    last = F.max(F.when(~drop, F.col(order))).over(Window.partitionBy(*part))
    return df.withColumn("_last", last).where(F.col(order) <= F.col("_last")).drop("_last")


def neighbours(df: DataFrame, value: str, part: list[str], before: str = "prev_nr", after: str = "next_nr", chunk: int = 1024) -> DataFrame:
    """The values before and after each, of distinct whole numbers.

    As in ``two_level_carry``, neighbours are looked up within chunks of values, and only the least and the greatest value of each chunk are sorted over a
    part, so no part is sorted in one task.
    """
    rows = df.withColumn("_chunk", F.floor(F.col(value) / chunk))
    inner, outer = _over([*part, "_chunk"], [value]), _over(part, ["_chunk"])
    ends = rows.groupBy(*part, "_chunk").agg(F.min(value).alias("_least"), F.max(value).alias("_most"))
    ends = ends.select(*part, "_chunk", F.lag("_most").over(outer).alias("_before"), F.lead("_least").over(outer).alias("_after"))
    found = rows.withColumn(before, F.lag(value).over(inner)).withColumn(after, F.lead(value).over(inner)).join(ends, [*part, "_chunk"])
    return found.withColumns({before: F.coalesce(before, "_before"), after: F.coalesce(after, "_after")}).drop("_chunk", "_before", "_after")
