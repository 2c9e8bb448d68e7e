"""Connected components of a table of links, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.session import stage_table


def _round(edges: DataFrame) -> DataFrame:
    """A large and a small star over edges from a vertex ``u`` to a smaller ``v``.

    In the large one each vertex links its larger neighbours to the smallest of its
    neighbours and itself, in the small one its smaller neighbours and itself to the
    smallest of these.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
    least = least.select("v", F.least("v", "m").alias("m"))
    large = edges.join(least, "v").select("u", F.col("m").alias("v"))
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return small.filter("u <> v").unionByName(own).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether each vertex with a smaller one has one only, and is the smaller one of none."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    met = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return met.agg(F.count_if(F.expr("up > 1 or (up = 1 and down = 1)"))).first()[0] == 0


def _named(links: DataFrame, known: DataFrame) -> DataFrame:
    """``links`` between the components that their ends are in."""
    for end in ("u", "v"):
        parts = known.select(F.col("vertex").alias(end), F.col("component").alias("__part"))
        links = links.join(parts, end, "left").withColumn(end, F.coalesce("__part", end)).drop("__part")
    return links


def connected_components(links: DataFrame, known: DataFrame | None = None, max_rounds: int = 60) -> DataFrame:
    """``(vertex, component)`` for every vertex of ``links(u, v)``; the component is its
    smallest vertex.

    ``known`` are the components of links found before: the new ones then join components,
    and the result holds the vertices of both.  So links that come in several lots are not
    gone through again, and a lot that joins nothing takes no round.

    Each round halves what is left of a path, so the rounds grow with the logarithm of the
    longest one.  The minimum of a vertex's neighbours is combined on the map side; tables
    of edges are written each round, which cuts the lineage.
    """
    ends = links.select(F.col("u").cast("long"), F.col("v").cast("long"))
    if known is not None:
        ends = _named(ends, known)
    edges = stage_table(
        ends.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    if known is not None and edges.isEmpty():
        return known
    for _ in range(max_rounds):
        if _settled(edges):
            break
        edges = stage_table(_round(edges), "edges")
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("vertex")).distinct()
    joined = edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    if known is None:
        return stage_table(joined.unionByName(roots.withColumn("component", F.col("vertex"))), "parts")
    # the root of each component is among its vertices, and a vertex without any is one itself
    renamed = joined.select(F.col("vertex").alias("component"), F.col("component").alias("__root"))
    ends = joined.select("vertex").unionByName(roots).withColumn("component", F.col("vertex"))
    old = known.select("vertex", "component").unionByName(ends).distinct()
    parts = old.join(renamed, "component", "left")
    return stage_table(parts.select("vertex", F.coalesce("__root", "component").alias("component")), "parts")
