"""Joins by order, by interval and on skewed keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_at: str, right_at: str, take: Sequence[str]) -> DataFrame:
    """``left`` with the columns ``take`` of the last row of ``right`` at or before it, of the same ``by``; null where there is none.

    Both sides go through one exchange and one sort on (by, time): no row of
    one side meets more than one of the other. Of several right rows at one
    time the greatest by ``take`` counts. Left rows with a null key or time get
    nulls; right ones are passed over. ``take`` must not name columns of ``left``.
    """
    found = F.struct(*take).alias("_found")
    r = right.where(F.col(right_at).isNotNull()).groupBy(*by, F.col(right_at).alias("_at")).agg(F.max(F.struct(*take)).alias("_found"))
    for key in by:
        r = r.where(F.col(key).isNotNull())
    kind = dict(right.select(found).dtypes)["_found"]
    rows = left.select(*by, F.col(left_at).alias("_at"), F.lit(1).alias("_side"), F.struct("*").alias("_row"), F.lit(None).cast(kind).alias("_found"))
    none = F.lit(None).cast(dict(rows.dtypes)["_row"])
    both = rows.unionByName(r.select(*by, "_at", F.lit(0).alias("_side"), none.alias("_row"), "_found"))
    order = Window.partitionBy(*by).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.when(F.col("_at").isNotNull(), F.last("_found", ignorenulls=True).over(order))
    return both.withColumn("_found", known).where("_side = 1").select("_row.*", *[F.col(f"_found.{c}").alias(c) for c in take])


def interval_join(points: DataFrame, ranges: DataFrame, at: Column, begin: Column, end: Column, width: int) -> DataFrame:
    """Pairs with begin <= at < end, all of them whole numbers; ranges are cut into cells of ``width``, so that the join has an equal key.

    A range is copied once for each cell that it touches, a point never; choose
    the width near that of a usual range. Nulls and empty ranges match nothing.
    The sides must not share column names.
    """
    cell = F.floor(F.col("_begin") / width)
    cells = F.sequence(cell, F.floor((F.col("_end") - 1) / width))
    r = ranges.withColumns({"_begin": begin.cast("long"), "_end": end.cast("long")}).where("_begin < _end").withColumn("_cell", F.explode(cells))
    p = points.withColumn("_at", at.cast("long")).withColumn("_point", F.floor(F.col("_at") / width))
    same = (F.col("_point") == F.col("_cell")) & (F.col("_at") >= F.col("_begin")) & (F.col("_at") < F.col("_end"))
    return p.join(r, same).drop("_begin", "_end", "_cell", "_at", "_point")


def salted_join(facts: DataFrame, keyed: DataFrame, key: str, salts: int = 16) -> DataFrame:
    """Inner join on ``key`` with each key's facts dealt to ``salts`` tasks and its ``keyed`` rows copied to them.

    For keys so frequent that a task can't hold them where the adaptive skew
    join doesn't apply, as before an aggregate on the same key. The other
    columns of the sides must differ. The result equals the plain join.
    """
    dealt = facts.withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int"))
    copies = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, [key, "_salt"]).drop("_salt")
