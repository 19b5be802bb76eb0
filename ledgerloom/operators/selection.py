"""The k-th row of a table in a total order, found by counting.

Nothing is sorted, numbered or written. Rows are counted between a few pivots
(first between days, then between rows drawn from what is left), the interval
that holds the k-th row is kept, and so on until it is few rows or copies of
one row. The result is a predicate, which later reads evaluate row by row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

FEW_ROWS = 10_000  # distinct rows that are looked at on the driver
PIVOTS = 63


def _literal(schema: T.StructType, order: Sequence[str], row: Row) -> Column:
    return F.struct(*[F.lit(row[name]).cast(schema[name].dataType).alias(name) for name in order])


def kth_row(df: DataFrame, order: Sequence[str], k: int, few_rows: int = FEW_ROWS) -> tuple[Row, int, int]:
    """The k-th row (from 1) by the columns ``order`` (nulls first), how many of its copies come up to the k-th, and all of them.

    ``order`` must name all columns that tell rows apart. Each round reads the
    rows once; a round cuts what is left to about a sixty-fourth.
    """
    schema, place = df.schema, F.struct(*order)
    left, n = df.select(*order), None
    while True:
        counted = left.groupBy(*order).agg(F.count(F.lit(1)).alias("_n"))
        if n is not None and n <= few_rows:
            for row in counted.orderBy(*[F.asc_nulls_first(c) for c in order]).collect():
                if k <= row["_n"]:
                    return row, k, row["_n"]
                k -= row["_n"]
            raise ValueError("there are fewer rows than k")
        if n is None:
            n = left.count()
            if k > n or k < 1:
                raise ValueError(f"no row {k} among {n}")
            continue
        drawn = left.sample(fraction=min(1.0, 8 * PIVOTS / n), seed=n % 1_000_003).distinct()
        pivots = drawn.orderBy(*[F.asc_nulls_first(c) for c in order]).limit(64 * PIVOTS).collect()
        pivots = pivots[:: max(1, len(pivots) // PIVOTS)] or [left.first()]
        # Two numbers for each pivot: the rows before it, and its own copies.
        listed = F.array(*[_literal(schema, order, p) for p in pivots])
        below = F.size(F.filter(listed, lambda p: p < place))
        slot = 2 * below + F.exists(listed, lambda p: p == place).cast("int")
        counts = {r["slot"]: r["n"] for r in left.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()}
        for at in sorted(counts):
            if k <= counts[at]:
                break
            k -= counts[at]
        if at % 2:
            return pivots[at // 2], k, counts[at]
        if at:
            left = left.where(place > _literal(schema, order, pivots[at // 2 - 1]))
        if at // 2 < len(pivots):
            left = left.where(place < _literal(schema, order, pivots[at // 2]))
        n = counts[at]


@dataclass(frozen=True)
class Cut:
    """The oldest ``n_reference`` rows of a table end at ``row``; ``kept`` of its ``copies`` belong to them."""

    schema: T.StructType
    date_column: str
    order: tuple[str, ...]
    row: Row
    kept: int
    copies: int
    n_reference: int
    n_current: int
    reference_start: datetime
    reference_end: datetime
    current_start: datetime | None
    current_end: datetime

    def split(self, df: DataFrame) -> DataFrame:
        """Add ``side``; rows without a date are ``current``.

        A comparison of each row with the cut, whose condition on the date
        reaches the scan where only one side is wanted. Copies of the cut's row
        that fall on both sides are made from the row itself.
        """
        when, end = F.col(self.date_column), F.lit(self.row[self.date_column]).cast(self.schema[self.date_column].dataType)
        place, cut = F.struct(*self.order), _literal(self.schema, self.order, self.row)
        before = (when < end) | ((when == end) & (place <= cut if self.kept == self.copies else place < cut))
        sided = df.withColumn("side", F.when(before, "reference").otherwise("current"))
        if self.kept == self.copies:
            return sided
        fields = [F.lit(self.row[f.name]).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        copies = df.sparkSession.range(self.copies).select(*fields, F.when(F.col("id") < self.kept, "reference").otherwise("current").alias("side"))
        return sided.where(when.isNull() | (when != end) | (place != cut)).unionByName(copies.select(*sided.columns))


def chronological_cut(df: DataFrame, fraction: float, date_column: str, tie_break: Sequence[str]) -> Cut:
    """Where the oldest ``int(n * fraction)`` rows end, by date, the tie-break columns and then every other column.

    One read counts the days; further ones read the day of the cut only.
    """
    when = F.col(date_column)
    per_day = df.groupBy(when.cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.min(when).alias("start"), F.max(when).alias("end"))
    in_order, whole = Window.orderBy(F.asc_nulls_last("day")), Window.partitionBy()
    counted = per_day.select(
        "day",
        "n",
        F.sum("n").over(in_order).alias("run"),
        F.lead("start").over(in_order).alias("next_start"),
        F.sum("n").over(whole).alias("total"),
        F.min("start").over(whole).alias("start"),
        F.max("end").over(whole).alias("end"),
    )
    cut = F.floor(F.col("total").cast("double") * F.lit(fraction)).cast("bigint")
    hit = counted.withColumn("cut", cut).where((F.col("cut") <= F.col("run")) & (F.col("cut") > F.col("run") - F.col("n"))).first()
    if hit is None or hit["cut"] == hit["total"]:
        raise ValueError(f"fraction {fraction} leaves one side of the split empty")
    if hit["day"] is None:
        raise ValueError(f"the split falls among rows without {date_column}")
    order = (date_column, *[c for c in tie_break if c in df.columns])
    order = (*order, *[c for c in df.columns if c not in order])
    # As timestamp ranges these conditions reach the scan.
    starts, ends = F.lit(hit["day"]).cast("timestamp_ntz"), F.date_add(F.lit(hit["day"]), 1).cast("timestamp_ntz")
    edge = df.where((when >= starts) & (when < ends))
    row, kept, copies = kth_row(edge, order, hit["cut"] - (hit["run"] - hit["n"]))
    if kept < copies:
        following = row[date_column]
    else:
        after = edge.where((when > F.lit(row[date_column])) | (F.struct(*order) > _literal(df.schema, order, row)))
        following = hit["next_start"] if hit["cut"] == hit["run"] else after.agg(F.min(when)).first()[0]
    return Cut(df.schema, date_column, order, row, kept, copies, hit["cut"], hit["total"] - hit["cut"], hit["start"], row[date_column], following, hit["end"])
