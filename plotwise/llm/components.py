"""Connected components of links between ids, in Spark rounds of the large-star and small-star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id and component (smallest id that can be reached) for every id of a link.

    Rounds go on until a round changes nothing. Each is stored, so a lost executor costs one round at most. A hot id
    (the middle of a large component) is joined by Spark's skew handling and summed up before the shuffle.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    pairs = stored(pairs, "links")
    before = None
    while True:
        # large star: larger neighbours of an id go to its smallest neighbour
        both = pairs.union(pairs.select("v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: an id and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        links_now = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        pairs = stored(links_now, "links")
        now = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v"))).first()
        if now == before:
            break
        before = now
    rooted = pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return rooted.union(pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
