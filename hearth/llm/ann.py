"""Nearest neighbours by inner product: a hierarchical k-means tree searched best bin first.

Inner products become distances by one more coordinate that gives every vector
the largest norm (a query has 0 there), so near in the tree is large in product.
The tree is fitted on a bounded sample (``sample_rows``, the least by hash) and
every vector is filed in its leaf.  A query opens nodes in the order of a
priority queue and notes the leaves as they come up; how many it visits is
calibrated: the true neighbours of ``calibration_queries`` vectors that the tree
was not fitted on are found among all rows by brute force, and the visits are
widened until ``recall`` of them lie in the visited leaves.  A query whose leaves
hold fewer than ``k + 1`` vectors goes on until they do.

Equal vectors are filed once, with their ``k + 1`` smallest ids -- no further
one can be in a result, ties going to the smaller id -- and equal queries are
searched once, so a vector that fills a third of the table costs no more than
any other.  Neighbouring leaves are searched together as a bundle of about
``bundle_rows`` vectors, larger leaves are cut into parts of that size, and so
are the queries of a bundle; every group returns the best of the leaves that a
query visits there, and a window merges them.

Defined results: null or zero vectors and vectors with null or non-finite
components take no part, nor do vectors of another length than the longest
that at least half of the rows have (else the most frequent length); null ids
take no part; rows that repeat an id and vector count once.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm import _common as C


@dataclass
class Tree:
    """Nodes in arrays: centre, children (a slice) or leaf number (-1: inner)."""

    centre: np.ndarray
    first: np.ndarray
    last: np.ndarray
    leaf: np.ndarray
    top: float              # the largest squared norm; what the added coordinate fills up to

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.top - np.einsum("ij,ij->i", x, x), 0))
        return np.column_stack([x, rest])

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: down the nearest centres."""
        x, node = self.lifted(x), np.zeros(len(x), np.int64)
        while True:
            inner = np.unique(node[self.leaf[node] < 0])
            if not len(inner):
                return self.leaf[node]
            for n in inner:
                own = np.flatnonzero(node == n)
                c = self.centre[self.first[n]:self.last[n]]
                node[own] = self.first[n] + _nearest(x[own], c)

    def visits(self, q: np.ndarray, leaves: int, sizes: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The first ``leaves`` leaves for a query, best bin first, and further ones until all hold ``least`` vectors (``sizes``: of leaves)."""
        q = np.append(q, 0.0)
        heap, out, held = [(0.0, 0)], [], 0
        while heap and (len(out) < leaves or held < least):
            _, n = heapq.heappop(heap)
            if self.leaf[n] >= 0:
                out.append(int(self.leaf[n]))
                held += int(sizes[out[-1]]) if sizes is not None else 0
                continue
            d = self.centre[self.first[n]:self.last[n]] - q
            for i, x in enumerate(np.einsum("ij,ij->i", d, d).tolist(), int(self.first[n])):
                heapq.heappush(heap, (x, i))
        return out


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (np.einsum("ij,ij->i", c, c) - 2 * x @ c.T).argmin(1)


def _kmeans(x: np.ndarray, k: int, rng, rounds: int = 8) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = _nearest(x, c)
        n = np.bincount(own, minlength=k)
        c = np.where(n[:, None] > 0, np.stack([np.bincount(own, x[:, j], minlength=k) for j in range(x.shape[1])], 1)
                     / np.maximum(n, 1)[:, None], c)
    return c


def build_tree(sample: np.ndarray, top: float, leaf_rows: int, branch: int = 8, seed: int = 7) -> Tree:
    rng = np.random.default_rng(seed)
    tree = Tree(np.zeros((1, sample.shape[1] + 1)), np.zeros(1, int), np.zeros(1, int), np.zeros(1, int), top)
    x = tree.lifted(sample)
    centre, first, last, leaf = [x.mean(0) if len(x) else tree.centre[0]], [0], [0], [-1]
    todo, leaves = [(0, np.arange(len(x)))], 0
    while todo:
        node, rows = todo.pop(0)
        k = min(branch, len(np.unique(x[rows], axis=0)) if len(rows) <= 4 * branch else branch)
        if len(rows) > leaf_rows and k > 1:
            c = _kmeans(x[rows], k, rng)
            own = _nearest(x[rows], c)
            kept = np.flatnonzero(np.bincount(own, minlength=k))
            if len(kept) > 1:
                first[node], last[node] = len(centre), len(centre) + len(kept)
                for j in kept:
                    todo.append((len(centre), rows[own == j]))
                    centre.append(c[j])
                    first.append(0), last.append(0), leaf.append(-1)
                continue
        leaf[node], leaves = leaves, leaves + 1
    return Tree(np.array(centre), np.array(first), np.array(last), np.array(leaf), top)


def best_rows(scores: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` best finite scores of each row, best first, ties to the smaller ``least`` of the column."""
    if scores.shape[1] > k:
        edge = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
        r, c = np.nonzero((scores >= edge) & (scores > -np.inf))
    else:
        r, c = np.nonzero(scores > -np.inf)
    order = np.lexsort((least[c], -scores[r, c], r))
    r, c = r[order], c[order]
    place = np.arange(len(r)) - np.searchsorted(r, r, "left")
    return r[place < k], c[place < k]


def calibrate(filed: DataFrame, tree: Tree, queries: np.ndarray, names: np.ndarray, k: int, recall: float) -> int:
    """The least number of leaf visits that finds ``recall`` of the queries' true neighbours among all rows but
    themselves (``names``: the queries' h1 and h2)."""
    def near(batches):
        import pandas as pd
        for batch in batches:
            for i in range(0, len(batch), 4096):
                part = batch.iloc[i:i + 4096]
                scores = queries @ np.stack(part["v"].to_numpy()).T
                scores[(names[:, :1] == part["h1"].to_numpy()) & (names[:, 1:] == part["h2"].to_numpy())] = -np.inf
                r, c = best_rows(scores, np.arange(len(part)), k)
                yield pd.DataFrame({"q": r, "leaf": part["leaf"].to_numpy()[c], "score": scores[r, c]})

    found = filed.mapInPandas(near, "q long, leaf long, score double")
    w = Window.partitionBy("q").orderBy(F.col("score").desc(), "leaf")
    true = found.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).select("q", "leaf").collect()
    order = [{leaf: i for i, leaf in enumerate(tree.visits(q, tree.leaves), 1)} for q in queries]
    needed = sorted(order[r["q"]][r["leaf"]] for r in true)
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)] if needed else 1


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v, h1, h2): rows that take part; h1 and h2 name the vector."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")) \
        .filter("id is not null and v is not null and size(v) > 0") \
        .filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    sizes = v.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col("d").desc())
    first = sizes.first()
    v = v.filter(F.size("v") == (first["d"] if first else 0))
    # -0.0 and 0.0 are one value
    v = v.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    return v.select("id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))


def search(vectors: DataFrame, is_query, k: int = 20, sample_rows: int = 20_000, leaf_rows: int = 256, recall: float = 0.96,
           bundle_rows: int = 16_384, calibration_queries: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for every row that ``is_query`` (a
    condition on ``id``) picks, against every row but its own."""
    C.ship_package(vectors.sparkSession)
    rows = C.written(usable(vectors, id_col, vector_col), "ann-rows")
    spark = rows.sparkSession
    name = ["h1", "h2"]
    # one row for each distinct vector, with the ids that can matter
    ids = rows.select(*name, "id").distinct()
    ids = ids.withColumn("r", F.row_number().over(Window.partitionBy(*name).orderBy("id"))).filter(F.col("r") <= k + 1)
    ids = ids.groupBy(*name).agg(F.sort_array(F.collect_list("id")).alias("ids"))
    one = rows.groupBy(*name).agg(F.min("id").alias("id"))
    distinct = C.written(rows.join(one, [*name, "id"]).dropDuplicates(name).select(*name, "v").join(ids, name), "ann-distinct")
    about = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("top")).first()
    n = distinct.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # sample_rows vectors at most, and those for calibration
    taken = distinct.orderBy("h1", "h2").limit(sample_rows + calibration_queries).select(*name, "v").collect()
    few = min(sample_rows, len(taken) - min(calibration_queries, len(taken) // 8))
    sample = np.array([r["v"] for r in taken[:few]])
    held = taken[few:][:calibration_queries] or taken        # of a handful of rows all
    tree = build_tree(sample, about["top"], max(8, round(leaf_rows * len(sample) / n)))
    shared = spark.sparkContext.broadcast(tree)              # at most sample_rows centres

    def file(batches):
        for batch in batches:
            if len(batch):
                yield batch.assign(leaf=shared.value.assign(np.stack(batch["v"].to_numpy())))

    filed = C.written(distinct.mapInPandas(file, "h1 long, h2 long, v array<double>, ids array<long>, leaf long"), "ann-filed")
    visits = calibrate(filed, tree, np.array([r["v"] for r in held]), np.array([(r["h1"], r["h2"]) for r in held]), k, recall)

    # leaves in tree order to bundles; at most sample_rows leaves
    sizes = {r["leaf"]: r["n"] for r in filed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    bundle_of, parts, filled = np.zeros(tree.leaves, np.int64), [1], 0
    for leaf in range(tree.leaves):
        own = sizes.get(leaf, 0)
        if filled and filled + own > bundle_rows:
            parts.append(1)
            filled = 0
        bundle_of[leaf], filled = len(parts) - 1, filled + own
        parts[-1] = max(1, -(-filled // bundle_rows))
    parts = np.array(parts)
    leaf_sizes = np.array([sizes.get(leaf, 0) for leaf in range(tree.leaves)])

    def route(batches):
        import pandas as pd
        for batch in batches:
            out = []
            for h1, h2, v in zip(batch["h1"], batch["h2"], batch["v"]):
                leaves = np.array(shared.value.visits(np.asarray(v), visits, leaf_sizes, k + 1))
                for b in np.unique(bundle_of[leaves]):
                    out.append((h1, h2, v, b, leaves[bundle_of[leaves] == b]))
            yield pd.DataFrame(out, columns=["h1", "h2", "v", "bundle", "leaves"])

    asked = rows.filter(is_query).select(*name).distinct().join(distinct.select(*name, "v"), name)
    routed = C.written(asked.mapInPandas(route, "h1 long, h2 long, v array<double>, bundle long, leaves array<long>"), "ann-routed")
    groups = routed.groupBy("bundle").agg(F.ceil(F.count(F.lit(1)) / bundle_rows).cast("int").alias("p"))   # one row a bundle
    where = spark.createDataFrame([(i, int(b), int(parts[b])) for i, b in enumerate(bundle_of)], "leaf long, bundle long, m int")
    where = F.broadcast(where.join(groups, "bundle"))        # one row a leaf
    salt = F.xxhash64(F.lit(7), *name)

    def dealt(df, on, own, other, n_own, n_other):
        return df.join(where if on == "leaf" else F.broadcast(where.select("bundle", "m", "p").distinct()), on) \
            .withColumn(own, F.pmod(salt, F.col(n_own)).cast("int")) \
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(n_other) - 1))).drop("m", "p")

    members, asking = dealt(filed, "leaf", "a", "b", "m", "p"), dealt(routed, "bundle", "b", "a", "p", "m")

    def best(have, ask):
        import pandas as pd
        out = []
        if len(have) and len(ask):
            least = np.array([x[0] for x in have["ids"]])
            x, q, leaf = np.stack(have["v"].to_numpy()), np.stack(ask["v"].to_numpy()), have["leaf"].to_numpy()
            order = np.argsort(leaf, kind="stable")
            least, x, leaf, ids = least[order], x[order], leaf[order], have["ids"].to_numpy()[order]
            for i in range(0, len(q), 64):
                some = q[i:i + 64]
                scores = np.full((len(some), len(x)), -np.inf)
                visiting: dict[int, list[int]] = {}
                for j, leaves in enumerate(ask["leaves"].iloc[i:i + 64]):
                    for n in leaves:
                        visiting.setdefault(int(n), []).append(j)
                for n, own in visiting.items():
                    lo, hi = np.searchsorted(leaf, [n, n + 1])
                    scores[own, lo:hi] = some[own] @ x[lo:hi].T
                r, c = best_rows(scores, least, k + 1)
                out.append(pd.DataFrame({"h1": ask["h1"].to_numpy()[i + r], "h2": ask["h2"].to_numpy()[i + r], "ids": ids[c], "score": scores[r, c]}))
        if not out:
            return pd.DataFrame({"h1": [], "h2": [], "ids": [], "score": []}).astype({"h1": "int64", "h2": "int64", "score": "float64"})
        return pd.concat(out)

    found = members.groupBy("bundle", "a", "b").cogroup(asking.groupBy("bundle", "a", "b")).applyInPandas(
        best, "h1 long, h2 long, ids array<long>, score double")
    # the best k + 1 rows of each distinct query
    near = found.withColumn("id", F.explode("ids")).drop("ids")
    w = Window.partitionBy(*name).orderBy(F.col("score").desc(), "id")
    near = near.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k + 1)
    lists = near.groupBy(*name).agg(F.sort_array(F.collect_list(F.struct("r", "id", "score"))).alias("near"))   # k + 1 entries
    queries = rows.filter(is_query).select("id", *name).distinct()
    own = queries.join(lists, name).select(F.col("id").alias("query_id"), F.posexplode(
        F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k)).alias("p", "x"))
    return own.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))


def op7_ann(spark, sf_dir: str) -> DataFrame:
    return search(C.read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
