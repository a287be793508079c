"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.llm.common import written

MAX_ROUNDS = 60


def _star(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the smallest of u and all its v; the minimum is taken by a partial
    aggregate, so a hub with very many links is no large group."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(low, "u")


def _links(stars: DataFrame) -> DataFrame:
    return stars.where("v <> m").select(F.greatest("v", "m").alias("a"), F.least("v", "m").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a long, b long), root: the component's
    smallest node. Rows with a null end or equal ends are no links. Each round is written
    to the shared folder, so a lost executor repeats one round at most.

    The loop ends when a round changes nothing; the number of rounds grows with the
    logarithm of the largest component. Raises when MAX_ROUNDS did not suffice.
    """
    links = written(links.where("a is not null and b is not null and a <> b")
                    .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    for _ in range(MAX_ROUNDS):
        both = links.selectExpr("a u", "b v").union(links.selectExpr("b u", "a v"))
        large = _links(_star(both).where("v > u"))  # bigger neighbours point to the smallest
        down = large.selectExpr("a u", "b v")
        small = _star(down)
        links = written(_links(small.select("v", "m").union(small.select(F.col("u").alias("v"), "m"))), "links")
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("the components did not settle")
    return links.selectExpr("a node", "b root").union(links.selectExpr("b node", "b root")).distinct()
