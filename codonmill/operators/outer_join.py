"""Full outer equi-join that stands a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def full_outer(many: DataFrame, one: DataFrame, on: str) -> DataFrame:
    """Rows of both sides, paired where `on` is equal; rows with a NULL key are dropped.

    `many` may repeat keys, up to a key that holds much of the table; `one` is
    close to one row per key. Spark's own full outer join can neither broadcast a
    small side nor split a skewed partition. A left join from `many` can do both;
    what only `one` has is found by a second left join, against the distinct keys
    of `many`, which are thinned out before their shuffle. Both read the same
    exchange of `one`. (An anti join would say the same as the second, but gets
    pushed down into `one`, which then has to be computed twice.)
    """
    many = many.where(F.col(on).isNotNull())
    one = one.where(F.col(on).isNotNull())
    found = many.select(on).distinct().withColumn("_found", F.lit(True))
    only_one = one.join(found, on, "left").where(F.col("_found").isNull()).drop("_found")
    paired = many.join(one, on, "left")
    # The optimizer keeps the column aliases of a union's first input, however deep.
    # New ones at its top let those below go, and both readings of `one` stay alike.
    renewed = paired.select(*[F.col(name).alias(name) for name in paired.columns])
    return renewed.unionByName(only_one, allowMissingColumns=True)
