"""Connected components of a link table, by minimum label with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from journeyline.llm import scratch


def components(links: DataFrame) -> DataFrame:
    """(a, b) links of long ids -> (id, comp): the smallest id reachable, for every linked id.

    Each round takes the least label among the neighbours and then the label of that label, so the number of
    rounds grows with the logarithm of a component's diameter. Labels are saved each round; only the count of
    changed labels comes to the driver. Nulls and self-links join nothing; no links give no rows.
    """
    ends = links.where("a is not null and b is not null and a <> b")
    both = scratch.save(ends.select("a", "b").unionAll(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = scratch.save(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("comp")), "labels")
    while True:
        near = (both.join(labels.select(F.col("id").alias("b"), "comp"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("near")))
        step = labels.join(near, "id").select("id", F.col("comp").alias("old"), F.least("comp", "near").alias("mid"))
        jump = labels.select(F.col("id").alias("mid"), F.col("comp").alias("far"))
        step = scratch.save(step.join(jump, "mid", "left").select("id", "old", F.least("mid", "far").alias("comp")), "labels")
        labels = step.select("id", "comp")
        if step.where("comp <> old").isEmpty():
            return labels
