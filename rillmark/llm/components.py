"""Connected components of links between ids, by rounds of joins.

Large-star and small-star rounds in turn: every round hangs neighbours on the
smallest id each node sees. Smallest ids are combined before the shuffle, and
joins are between written tables, so AQE splits a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import dropped, saved


def _star(links: DataFrame, small: bool) -> DataFrame:
    """u > v in, u > v out, written: each node's (small: smaller; else: larger) neighbours, hung on its smallest."""
    both = links if small else links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    if not small:
        # A node of very many links: written, so that AQE can split its join. In small stars
        # a node only meets the smallest ids that its neighbours saw.
        least = saved(least, "star-least")
    met = both.join(least, "u")
    if small:
        hung = met.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            least.select("u", F.col("least").alias("v"))
        )
    else:
        hung = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    out = saved(hung.where(F.col("u") != F.col("v")).distinct(), "small-star" if small else "large-star")
    if not small:
        dropped(least)
    return out


def components(links: DataFrame) -> DataFrame:
    """id, component (its smallest id) of every id in `links` (a, b), a written table."""
    u, v = F.greatest("a", "b"), F.least("a", "b")
    now = links.where("a <> b").select(u.alias("u"), v.alias("v")).distinct()
    before = None
    while True:
        large = _star(now, small=False)
        now = _star(large, small=True)
        dropped(large, *([before] if before is not None else []))
        before = now
        # Done when nothing that others hang on hangs on anything.
        heads = now.select(F.col("v").alias("u")).distinct()
        if heads.join(now.select("u"), "u", "left_semi").isEmpty():
            break
    heads = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(heads)
