"""Connected components of an edge table by label propagation with shortcuts.

Every node takes the smallest label among itself and its neighbours, then the
label of its label, until nothing changes. Each round is written to the shared
folder, so lost executors cost one round at most; nothing but one count per
round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v; any orderable type) to ``u, label``: the smallest node
    of u's component, for every u with an edge."""
    edges = edges.where("u != v")
    both = c.stage(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = c.stage(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("label").alias("near"))
        step = labels.join(near, "u").select("u", "label", F.least("label", "near").alias("new"))
        step = c.stage(step, "labels")
        jump = step.select(F.col("u").alias("t"), F.col("new").alias("far"))
        after = step.join(jump, F.col("new") == F.col("t")).select("u", "label", F.least("new", "far").alias("new"))
        after = c.stage(after, "labels")
        labels = after.select("u", F.col("new").alias("label"))
        if after.where("new != label").isEmpty():
            return labels
