"""Places in a whole order, without one task that holds all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstone.session import materialize

#: monotonically_increasing_id keeps the partition above so many bits, and the row inside it below.
_PART_BITS = 33


def number_rows(df: DataFrame, *order: Column | str, name: str = "place", first: int = 0, parts: int | None = None) -> DataFrame:
    """df with `name`, each row's place in the whole order, from `first` on; a column of that name is replaced.

    Rows are dealt by ranges of the order and sorted inside each, and the sizes of the ranges, one row for each of
    `parts` (spark.sql.shuffle.partitions), give the places at which they begin. One exchange of the rows. Rows that
    are alike in `order` go to one range, so an order should end with something that tells rows apart. df is read
    twice, for the bounds of the ranges and to deal: it should give the same rows each time.
    """
    count = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    inside, part, begins, size = (free_name(df, stem) for stem in ("inside", "part", "begins", "size"))
    own = [f"`{c}`" for c in df.columns if c != name]
    keys = [o if isinstance(o, Column) else F.col(o) for o in order]
    sorted_parts = df.repartitionByRange(count, *keys).sortWithinPartitions(*keys)
    stored = materialize(sorted_parts.withColumn(inside, F.monotonically_increasing_id()), "numbered")
    stored = stored.withColumn(part, F.shiftright(inside, _PART_BITS))
    sizes = stored.groupBy(part).agg(F.count(F.lit(1)).alias(size))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    starts = sizes.select(part, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(begins))
    place = F.col(begins) + F.col(inside).bitwiseAND((1 << _PART_BITS) - 1) + first
    return stored.join(F.broadcast(starts), part).select(*own, place.alias(name))


def free_name(df: DataFrame, stem: str) -> str:
    """A name that no column of df has, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while stem in taken:
        stem += "_"
    return stem
