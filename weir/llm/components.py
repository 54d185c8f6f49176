"""Connected components of a link table, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """``id, root``: for each end of the links ``a, b`` the smallest id it is connected with.

    In each round every id takes the smallest root among its neighbours' and then its root's root, so the rounds follow
    the logarithm of the longest chain. Minimums are taken before the shuffle, and joins let Spark split an id with very
    many links.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .distinct(), "links")
    roots = stored(both.groupBy("a").agg(F.min("b").alias("b"))
                   .select(F.col("a").alias("id"), F.least("a", "b").alias("root")), "roots")
    while True:
        near = both.join(roots, F.col("b") == F.col("id")).groupBy("a").agg(F.min("root").alias("near"))
        lower = roots.join(near, F.col("id") == F.col("a")).select("id", "root", F.least("root", "near").alias("next"))
        above = roots.select(F.col("id").alias("_id"), F.col("root").alias("_root"))
        jumped = stored(lower.join(above, F.col("next") == F.col("_id"))
                        .select("id", F.least("next", "_root").alias("root"), (F.least("next", "_root") < F.col("root"))
                                .alias("moved")), "roots")
        roots = jumped.select("id", "root")
        if not jumped.where("moved").limit(1).count():
            return roots
