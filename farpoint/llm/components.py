"""Connected components of a link table by minimum labels, hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_path, materialise_at
from .common import fixed


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): component is the smallest node.

    Each round takes the smallest label among a node and its neighbours, combined
    before it is shuffled, and offers it to the node and to the node that its label names:
    whole trees of labels hook on to lower ones, so long chains take few rounds. Then it
    replaces a label by the label's own label. Rounds go on until nothing changes. Every
    round is written and read again, so Spark plans the next one by the size of its files.
    A checkpoint keeps the size that Spark guessed: joins multiply guesses, and that one
    number, twice as long with every round, fills the driver after some twenty rounds.
    """
    spark = links.sparkSession
    both, both_at = materialise_at(
        links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .union(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
        .distinct(), "neighbours")
    labels, at = materialise_at(both.groupBy("node").agg(
        F.least("node", F.min("other")).alias("component")), "labels")
    same = labels.schema["component"].dataType
    while True:
        near = (both.join(labels.withColumnRenamed("node", "other"), "other")
                .groupBy("node").agg(F.min("component").alias("near")))
        offers = F.array(
            F.struct("node", "component", F.least("component", "near").alias("lower")),
            F.struct(F.col("component").alias("node"), F.lit(None).cast(same).alias("component"),
                     F.col("near").alias("lower")))
        lower = (labels.join(near, "node").select(F.explode(offers).alias("offer"))
                 .select("offer.*").groupBy("node").agg(
                     F.max("component").alias("old"), F.min("lower").alias("component")))
        jump = lower.select(F.col("node").alias("component"), F.col("component").alias("jump"))
        step, next_at = materialise_at(lower.join(jump, "component").select(
            "node", "old", F.least("component", "jump").alias("component")), "labels")
        drop_path(spark, at)
        labels, at = step.select("node", "component"), next_at
        if step.filter(F.col("old") != F.col("component")).isEmpty():
            break
    found = fixed(labels)
    for path in (both_at, at):
        drop_path(spark, path)
    return found
