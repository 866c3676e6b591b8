"""Calendar spines and gap filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from urbanlake.operators.merge import upsert


def date_bounds(df: DataFrame, date_col: str) -> DataFrame:
    """One row with the first and last date."""
    return df.agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"))


def date_spine(df: DataFrame, date_col: str, keys: list[str]) -> DataFrame:
    """Every key with every date of the whole frame's range.

    The range is a scalar subquery that each key expands in place.
    """
    bounds = date_bounds(df, date_col)
    low, high = bounds.select("min_date").scalar(), bounds.select("max_date").scalar()
    return df.select(*keys).distinct().withColumn(date_col, F.explode(F.sequence(low, high)))


def join_spine(spine: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """Spine rows with the observation of their key, if there is one."""
    return spine.join(observed, keys, "left")


def forward_fill(df: DataFrame, keys: list[str], order: str, cols: list[str], block: Column | None = None) -> DataFrame:
    """Carry the last non-null value of each column forward within ``keys``.

    With ``block`` (a coarser value of ``order``, such as its month) a key is
    split into many tasks: values are filled inside each block, and the last
    value of the blocks before it, one row per block, fills the start. ``df``
    is then read twice, so stage it when it is costly.
    """
    if block is None:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
    # One struct column partitions the window and the join alike, so the rows move once; null keys are equal in it.
    split = df.withColumn("_group", F.struct(*[F.col(k) for k in keys], block.alias("_block")))
    inside = Window.partitionBy("_group").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*[F.col(f"_group.{k}") for k in keys]).orderBy("_group._block")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    newest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_last_{c}") for c in cols]
    carry = (
        split.groupBy("_group")
        .agg(*newest)
        .select("_group", *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}") for c in cols])
    )
    filled = split.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in cols}).join(carry, "_group", "left")
    return filled.select(
        *[F.coalesce(c, f"_carry_{c}").alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def fill_gaps(df: DataFrame, keys: list[str], date_col: str, until: Column | None = None) -> DataFrame:
    """One row per key and day from its first observation to ``until``.

    Each observation expands to the days before the next one, so no spine is
    built or joined. ``df`` must hold at most one row per key and day; added
    days have ``is_filled`` true and otherwise repeat the observation.
    ``until`` defaults to the last date of the whole frame.
    """
    if until is None:
        until = df.agg(F.max(date_col)).scalar()
    following = F.lead(date_col).over(Window.partitionBy(*keys).orderBy(date_col))
    last_day = F.coalesce(F.date_sub("_following", 1), F.greatest(until, F.col(date_col)))
    spread = df.withColumn("_following", following).withColumn("_day", F.explode(F.sequence(F.col(date_col), last_day)))
    return spread.withColumn("is_filled", F.col("_day") != F.col(date_col)).select(
        *[F.col("_day").alias(date_col) if c == date_col else F.col(c) for c in df.columns], "is_filled"
    )


def fill_increment(
    silver: DataFrame, batch: DataFrame, keys: list[str], date_col: str, year_col: str | None = None
) -> DataFrame:
    """The filled rows that change when ``batch`` arrives on a filled ``silver``.

    Only days from the batch's first date on can change, and days after the
    end of ``silver``. Each key is seeded with its last observation before
    them, which the filled row of the day before carries; older rows are not
    read. ``year_col`` names a folder column of ``silver`` with the date's year:
    then older folders are pruned, at run time. It is not in the result.
    """
    first_new, last_new = batch.agg(F.min(date_col)).scalar(), batch.agg(F.max(date_col)).scalar()
    newest = silver.filter(F.col(year_col) == silver.agg(F.max(year_col)).scalar()) if year_col else silver
    last_old = newest.agg(F.max(date_col)).scalar()
    start = F.least(first_new, F.date_add(last_old, 1))
    if year_col:
        silver = silver.filter(F.col(year_col) >= F.year(F.date_sub(start, 1))).drop(year_col)
    seed = silver.filter(F.col(date_col) == F.date_sub(start, 1)).drop("is_filled")
    later = silver.filter((F.col(date_col) >= start) & ~F.col("is_filled")).drop("is_filled")
    recent = upsert(later, batch, [*keys, date_col])
    until = F.greatest(last_old, last_new)
    return fill_gaps(seed.unionByName(recent), keys, date_col, until).filter(F.col(date_col) >= start)
