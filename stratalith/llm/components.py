"""Connected components of a graph whose links stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratalith.llm.common import few_files, hot_in, release, settled
from stratalith.operators.joins import spread_join


def _weight(labels: DataFrame):
    """Labels only ever fall, so an unchanged total means that nothing changed."""
    return labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; a component is named by its smallest node.

    In every round a node takes the smallest label around it, passes it on to the node that its old
    label names, and then follows labels one step further. Chains shrink by a factor in each round,
    stars need two. Each round is written to the shared folder, so the plan does not grow, and the one before is deleted. A node
    with very many links, and a label that very many nodes have, are spread over the tasks. Nothing is
    collected but one number a round and the few hot values. Null ends and loops are ignored; no links give no rows.
    """
    spark = links.sparkSession
    links = links.select("a", "b").where("a <> b")
    ends = settled(few_files(links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a")).distinct()), "ends")
    hot = hot_in(ends, "node")
    labels = settled(few_files(ends.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("component"))), "labels")
    before = _weight(labels)
    while before is not None:
        near = spread_join(ends, labels, "node", "inner", row_id="other", hot=hot).groupBy("other").agg(F.min("component").alias("near"))
        seen = labels.join(near, labels.node == near.other).select("node", "component", F.least("component", "near").alias("near"))
        told = seen.select("node", "near").union(seen.where("near < component").select("component", "near"))
        hooked = settled(few_files(told.groupBy("node").agg(F.min("near").alias("component"))), "hooked")
        above = hooked.select(F.col("node").alias("component"), F.col("component").alias("above"))
        jumped = spread_join(hooked, above, "component", "inner", row_id="node", hot=hot_in(hooked, "component"))
        new = settled(few_files(jumped.select("node", F.least("component", "above").alias("component"))), "labels")
        release(spark, labels, hooked)
        labels, after = new, _weight(new)
        if after == before:
            break
        before = after
    release(spark, ends)
    return labels
