"""Connected components of a link table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame, a: str = "x", b: str = "y") -> DataFrame:
    """(v, c): for every end of a link, the smallest end of its component.

    Each round takes the smallest label among neighbours and then the label of that label, so
    long chains halve; every round is written to the shared folder, which ends its lineage.
    Null ends are ignored, an empty table gives an empty one, repeated links change nothing.
    """
    ends = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = materialize(ends.union(ends.select("v", "u")).distinct())
    labels = materialize(both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("c")))
    while True:
        seen = both.join(labels.select(F.col("v").alias("u"), F.col("c").alias("n")), "u").groupBy("v").agg(F.min("n").alias("n"))
        low = labels.join(seen, "v").select("v", F.col("c").alias("old"), F.least("c", "n").alias("c"))
        of = labels.select(F.col("v").alias("c"), F.col("c").alias("cc"))
        new = materialize(low.join(of, "c", "left").select("v", "old", F.least("c", F.coalesce("cc", "c")).alias("c")))
        labels = new.select("v", "c")
        if not new.where("old <> c").limit(1).count():
            return labels
