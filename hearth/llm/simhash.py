"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints: ASCII-lower-cased words, word shingles (repeats included), the
majority of each bit over the shingles' XXH64.

Links: two different fingerprints at ``max_bits`` or fewer differing bits.
With ``max_bits + 1`` blocks one block of the two is equal, so every distinct
fingerprint goes once to each of its blocks' buckets.  A task sorts its
buckets' codes by Gray rank, so that neighbours share most bits, and stacks
nodes over them: a node holds the bits that all codes below agree on (mask and
pattern).  All codes descend together: the bits in which a code differs from a
node's pattern accumulate on the way down; a group is dropped whole when they
exceed the limit and taken whole when even all free bits cannot exceed it.
Of the links found, a task returns a spanning forest -- the components are the
same and no group emits its pairs.  Buckets beyond ``bucket_rows`` codes are
cut into parts, and each pair of parts meets in its own group.

Defined results: null or wordless texts have fingerprint 0 and link like any
other; fewer words than a shingle make one shingle; repeated rows share their
fingerprint; a null id forms no component id of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm import _common as C
from hearth.llm._graph import connected_components

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_POP16 = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def fingerprint(text: str, shingle: int = 4) -> int:
    """The unsigned 64-bit SimHash of one whole text."""
    ws = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not ws:
        return 0
    data = b" ".join(ws)
    digest = xxhash.xxh64_intdigest
    if len(ws) <= shingle:
        return digest(data, 42)
    ends = np.cumsum([len(w) + 1 for w in ws]) - 1
    starts = (np.append(0, ends[:-1] + 1)[:len(ws) - shingle + 1]).tolist()
    ends = ends[shingle - 1:].tolist()
    h = np.array([digest(data[a:b], 42) for a, b in zip(starts, ends)], np.uint64)
    votes = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 14):
        votes += np.unpackbits(h[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(h), bitorder="little").view(np.uint64)[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed long."""
    return C.map_text(C.id_and_text(docs, id_col, text_col),
                      lambda texts: [[_signed(fingerprint(t, shingle)) for t in texts]],
                      T.StructType([T.StructField("fp", T.LongType())]), keep=["id"])


def _bits(x: np.ndarray) -> np.ndarray:
    return _POP16[x.view(np.uint16).reshape(-1, 4)].sum(1, dtype=np.int64)


def _gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of a code in the reflected Gray sequence."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


def _levels(codes: np.ndarray, bucket: np.ndarray, fan: int = 8) -> list:
    """Nodes over codes sorted by (bucket, Gray rank), from the leaves up:
    (pattern, mask, first child, end child, first code, end code, bucket).  A node stays within its bucket."""
    pattern, mask = codes, np.full(len(codes), np.uint64(0xFFFFFFFFFFFFFFFF))
    span = np.arange(len(codes) + 1)
    lo, hi, owner = span[:-1], span[1:], bucket
    out = [(pattern, mask, lo, hi, lo, hi, owner)]
    while len(owner) > 1:
        new = np.append(True, owner[1:] != owner[:-1])
        begin = np.flatnonzero(new)
        within = np.arange(len(owner)) - np.repeat(begin, np.diff(np.append(begin, len(owner))))
        first = np.flatnonzero(within % fan == 0)
        if len(first) == len(owner):
            break
        last = np.append(first[1:], len(owner))
        ones = np.bitwise_and.reduceat(pattern, first)
        zeros = np.bitwise_and.reduceat(~pattern & mask, first)
        # a bit is shared if every child fixes it, to the same value
        mask = ((ones & np.bitwise_and.reduceat(mask, first)) | zeros)
        pattern = ones & mask
        lo, hi, owner = lo[first], hi[last - 1], owner[first]
        out.append((pattern, mask, first, last, lo, hi, owner))
    return out


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of the edges (a, b): vertex, least vertex."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def shard_links(codes: np.ndarray, bucket: np.ndarray, max_bits: int, pairs: int = 1 << 20):
    """Spanning links (code index pairs) among the codes of each bucket."""
    order = np.lexsort((_gray_rank(codes), bucket))
    codes, bucket = codes[order], bucket[order]
    levels = _levels(codes, bucket)
    top = levels[-1]
    first_top = np.searchsorted(top[6], bucket, "left")
    end_top = np.searchsorted(top[6], bucket, "right")
    fa, fb = np.zeros(0, np.int64), np.zeros(0, np.int64)
    # work lists (level, codes, nodes) are split so that no list exceeds ``pairs``
    stack = []
    counts = end_top - first_top
    cut = np.searchsorted(np.cumsum(counts), np.arange(0, counts.sum() + pairs, pairs), "left")
    for s, e in zip(cut[:-1], cut[1:]):
        stack.append((len(levels), np.arange(s, e), first_top[s:e], end_top[s:e]))
    if len(cut) and cut[-1] < len(codes):
        stack.append((len(levels), np.arange(cut[-1], len(codes)), first_top[cut[-1]:], end_top[cut[-1]:]))
    while stack:
        level, q, lo, hi = stack.pop()
        n = hi - lo
        total = int(n.sum())
        if not total:
            continue
        if total > pairs and len(q) > 1:
            h = len(q) // 2
            stack += [(level, q[:h], lo[:h], hi[:h]), (level, q[h:], lo[h:], hi[h:])]
            continue
        q = np.repeat(q, n)
        node = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        pattern, mask, child, child_end, begin, end, _ = levels[level - 1]
        later = end[node] > q + 1            # only codes after q: each pair is looked at once
        q, node = q[later], node[later]
        differ = _bits((codes[q] ^ pattern[node]) & mask[node])
        near = differ <= max_bits
        q, node, differ = q[near], node[near], differ[near]
        whole = differ + 64 - _bits(mask[node]) <= max_bits
        # a whole group: its codes differ in free bits only, so they are linked to each other by their own descent
        a, b = q[whole], np.maximum(begin[node[whole]], q[whole] + 1)
        if len(a):
            fa, fb = _forest(np.concatenate([fa, b]), np.concatenate([fb, a]))
        if level > 1:
            q, node = q[~whole], node[~whole]
            stack.append((level - 1, q, child[node], child_end[node]))
    return order[fa], order[fb]


def links(codes: DataFrame, max_bits: int = 4, bucket_rows: int = 20_000, task_rows: int = 200_000) -> DataFrame:
    """``codes`` (fp: distinct longs).  Returns spanning links (a, b) of the
    graph that links codes at ``max_bits`` or fewer differing bits."""
    n = max_bits + 1
    edges = [round(i * 64 / n) for i in range(n + 1)]
    blocks = F.array(*[F.struct(F.lit(i).alias("block"),
                                F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("value"))
                       for i, (lo, hi) in enumerate(zip(edges, edges[1:]))])
    keyed = codes.select("fp", F.inline(blocks))
    # buckets too large for one group: few, each of more than bucket_rows codes
    sizes = keyed.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket_rows)
    parts = keyed.join(sizes, ["block", "value"], "left") \
        .withColumn("parts", F.ceil(F.coalesce("n", F.lit(1)) / bucket_rows).cast("int")) \
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .select("block", "value", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "fp")
    dealt = parts.repartition("block", "value", "p", "q").sortWithinPartitions("block", "value", "p", "q")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches):
        held: list[np.ndarray] = []
        rows = 0

        def solve(m):
            same = np.any(m[1:, :4] != m[:-1, :4], axis=1)
            bucket = np.append(0, np.cumsum(same))
            codes = m[:, 4].copy().view(np.uint64)
            a, b = shard_links(codes, bucket, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(m[a, 4]), pa.array(m[b, 4])], names=["a", "b"])

        for batch in batches:
            held.append(np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)]))
            rows += len(held[-1])
            if rows >= task_rows:
                m = np.concatenate(held)
                change = np.flatnonzero(np.any(m[1:, :4] != m[:-1, :4], axis=1))
                end = change[-1] + 1 if len(change) else 0    # the last bucket may go on
                if end:
                    yield solve(m[:end])
                held, rows = [m[end:]], len(m) - end
        if rows:
            yield solve(np.concatenate(held))

    return dealt.mapInArrow(run, schema).distinct()


def _rooted(fps: DataFrame, first, max_bits: int) -> DataFrame:
    """(fp, first, root) of every distinct code: the least ``first`` of its rows, and one code that names its component."""
    codes = C.written(fps.groupBy("fp").agg(F.min(first).alias("first")), "simhash-codes")
    # node, root: codes in a component of two or more
    graph = connected_components(links(codes.select("fp"), max_bits))
    return codes.join(graph, codes["fp"] == graph["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def _by_code(named: DataFrame, out_col: str) -> DataFrame:
    """(fp, ``out_col``): the least ``first`` of the code's component."""
    least = named.groupBy("root").agg(F.min("first").alias(out_col))
    return named.join(least, "root").select("fp", out_col)


def components(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """``fps`` (id, fp).  Returns (id, fp, component): the smallest id that can
    be reached over links, the row's own included."""
    by_code = _by_code(_rooted(fps, F.col("id"), max_bits), "component")
    return fps.join(by_code, "fp").select("id", "fp", "component")


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    fps = C.written(fingerprints(C.read(spark, sf_dir, "documents")), "simhash")
    return components(fps).select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                  F.col("component").alias("component_id"))


def one_of_each_group(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component one row stays, the first by (id, text
    digest), null ids last.  The decision is made by row, not by id: rows that
    share an id but hold unrelated texts all stay, and copies without an id go."""
    rows = C.id_and_text(docs).withColumn("digest", F.xxhash64("text", F.lit(1)))
    fps = C.written(C.map_text(rows, lambda texts: [[_signed(fingerprint(t)) for t in texts]],
                               T.StructType([T.StructField("fp", T.LongType())]), keep=["id", "digest"]), "simhash")
    kept = _by_code(_rooted(fps, F.struct(F.col("id").isNull().alias("no_id"), "id", "digest"), 4), "kept")
    # (id, digest) pairs that are not the kept one of their component
    drop = fps.join(kept, "fp").filter(~(F.col("id").eqNullSafe(F.col("kept.id")) & (F.col("digest") == F.col("kept.digest"))))
    drop = C.written(drop.select(F.col("id").alias("__id"), F.col("digest").alias("__digest")).distinct(), "simhash-drop")
    marked = docs.withColumn("__key", F.xxhash64(F.coalesce("text", F.lit("")), F.lit(1)))
    # texts that surely stay do not move
    some, stay = C.likely_among(marked, [F.col("doc_id").cast("long"), F.col("__key")], drop)
    left = stay.union(
        some.join(drop, (some["__key"] == drop["__digest"]) & some["doc_id"].cast("long").eqNullSafe(drop["__id"]), "left_anti"))
    return C.one_row_per_key(left, "doc_id", "__key").select(*docs.columns)
