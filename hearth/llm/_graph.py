"""Connected components by alternating large-star and small-star rounds.

Each round is two grouped minima and two joins over the edges, so no vertex's
neighbours are gathered anywhere, and a star-shaped input (what the matching
operators emit) is settled in two or three rounds.  Every round is written to
the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm import _common as C


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a, b), a > b.  Large star: link a vertex's larger neighbours to
    its least neighbour.  Small star: link its smaller neighbours and itself."""
    e = edges.select("a", "b")
    if large:
        e = e.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = e.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    around = e.join(least, "a")
    if large:
        out = around.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = around.select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .union(least.select("a", F.col("m").alias("b")))
    return out.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``edges`` (a, b: long).  Returns (node, root) for every vertex of an
    edge; ``root`` is the component's smallest vertex."""
    e = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = C.written(e, "components")
    before = None
    for _ in range(max_rounds):
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        if not state[0]:
            break
        e = C.written(_star(_star(e, True), False), "components")
    else:
        raise RuntimeError("connected components did not settle")
    # settled: every edge points at its component's smallest vertex
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .union(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
