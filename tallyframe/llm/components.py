"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.plans import Scratch, join_groups


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, root``: every node of ``links(u, v)`` with the least node it is linked to.

    Alternates two steps on the link table until nothing changes: each node hands the
    least of its neighbours to its larger neighbours, then to its smaller ones. Rounds
    grow with the logarithm of the longest chain. Neighbour minima are summed up in the
    map tasks first; the join back goes through ``join_groups``, which keeps hubs out of
    the shuffle. Self links are allowed and give their node as its own root; no links
    give no rows.
    """
    with Scratch(links.sparkSession, scratch.folder) as rounds:
        larger = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        nodes = rounds.keep(links.selectExpr("explode(array(u, v)) AS node").distinct())
        edges = rounds.keep(links.where("u <> v").select(*larger).distinct())
        before = None
        while True:
            after = tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())
            if after == before or after[0] == 0:
                break
            before = after
            both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
            stars = _with_least(both, rounds).where("v > u").selectExpr("v AS u", "m AS v")
            stars = rounds.keep(stars.distinct())
            around = _with_least(stars, rounds).selectExpr(
                "explode(array(struct(u AS u, m AS v), struct(v AS u, m AS v))) AS e"
            )
            edges = rounds.keep(around.select("e.*").where("u <> v").distinct())
        found = nodes.join(edges.withColumnRenamed("u", "node"), "node", "left")
        return scratch.keep(found.selectExpr("node", "coalesce(v, node) AS root"))


def _with_least(edges: DataFrame, rounds: Scratch) -> DataFrame:
    """``u, v, m``: each link with the least of ``u`` and its neighbours."""
    least = rounds.keep(
        edges.groupBy(F.col("u").alias("key")).agg(
            F.least("key", F.min("v")).alias("m"), F.count("*").alias("total")
        )
    )
    rows = edges.withColumnRenamed("u", "by")
    return join_groups(rows, least.select("key", "m"), least).selectExpr("by AS u", "v", "m")
