"""Ranked lexical search with the sides reversed: the items are indexed and the documents are streamed.

The items (queries) become an inverted index from term to (item, repeats) that
every task holds; each document's term counts run through it once and the
document is offered to a bounded heap per item.  A task returns its heaps, at
most ``k`` rows an item; heaps are merged in two steps, first inside a number of
salts, so no task reads the heaps of all others.

The index is broadcast in blocks of items: a block holds about ``block_terms``
term occurrences and ``block_items`` items (a single larger item is a block of
its own), and every block meets all documents.  Document counts, lengths and
frequencies cover every document.

Defined results: a null text has no terms and is never ranked; rows of a
repeated ``doc_id`` are ranked each for itself; a null ``doc_id`` ranks after
others of its score; rows that share an item's id are one item, which has the
terms of its distinct texts; an item without terms or without a hit has no
rows; with no documents or items the result is empty.
"""

from __future__ import annotations

import math
from collections import Counter
from heapq import heappush, heappushpop

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm import _common as C
from hearth.session import scratch_table_path

# ASCII that is no letter or digit separates terms; only A-Z are lower-cased
_TO_TERMS = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

CELLS = 4_000_000   # scores held at once in a task: documents x items
MERGES = 64         # salts of the first merge
_NO_ID = -(1 << 63)


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_TO_TERMS).split()


class Index:
    """Postings of a block of items: for each term its items and how often it stands in them."""

    def __init__(self, items: list, postings: dict[bytes, list[tuple[int, int]]]):
        self.items = items
        self.number = {t: i for i, t in enumerate(postings)}
        sizes = [len(p) for p in postings.values()]
        self.start = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        flat = [e for p in postings.values() for e in p]
        self.item = np.array([i for i, _ in flat], dtype=np.int64)
        self.repeats = np.array([n for _, n in flat], dtype=np.int64)
        self.weight = np.zeros(len(sizes), dtype=np.int64)
        self.n_docs, self.n_terms = 0, 0

    def weigh(self, n_docs: int, n_terms: int, df: dict[int, int]) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        for i in range(len(self.weight)):
            self.weight[i] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1)))

    def counts(self, text: str) -> tuple[int, Counter]:
        """Length of a text in terms and the counts of its indexed terms."""
        found = terms(text)
        known = Counter(map(self.number.get, found))
        known.pop(None, None)
        return len(found), known

    def scores(self, rows: list[tuple[int, Counter]]) -> np.ndarray:
        """Scores (documents x items) of rows of ``counts``."""
        n_items = len(self.items)
        doc = np.repeat(np.arange(len(rows)), [len(c) for _, c in rows])
        term = np.fromiter((t for _, c in rows for t in c), np.int64, len(doc))
        tf = np.fromiter((n for _, c in rows for n in c.values()), np.int64, len(doc))
        m = np.array([75 + 25 * n * self.n_docs // self.n_terms for n, _ in rows], dtype=np.int64)[doc]
        gain = self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
        sizes = self.start[term + 1] - self.start[term]
        each = np.repeat(np.arange(len(doc)), sizes)
        at = np.arange(len(each)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.start[term][each]
        out = np.zeros(len(rows) * n_items, dtype=np.int64)
        np.add.at(out, doc[each] * n_items + self.item[at], gain[each] * self.repeats[at])
        return out.reshape(len(rows), n_items)


class Heaps:
    """The ``k`` best documents of each item so far, the worst of them on top."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(n_items)]
        self.least = np.ones(n_items, dtype=np.int64)   # a score below this cannot enter

    def offer(self, ids: list, scores: np.ndarray) -> None:
        docs, items = np.nonzero(scores >= self.least)
        for d, i, s in zip(docs.tolist(), items.tolist(), scores[docs, items].tolist()):
            heap = self.heaps[i]
            entry = (s, _NO_ID if ids[d] is None else -ids[d])
            if len(heap) < self.k:
                heappush(heap, entry)
            elif entry > heap[0]:
                heappushpop(heap, entry)
        for i in np.unique(items):
            if len(self.heaps[i]) == self.k:
                self.least[i] = self.heaps[i][0][0]


def _blocks(items: DataFrame, block_terms: int, block_items: int, id_col: str, text_col: str):
    """Inverted indexes of the items, one block after the other."""
    each = items.select(F.col(id_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    found = C.map_text(each, lambda texts: [[terms(t) for t in texts]],
                       T.StructType([T.StructField("terms", T.ArrayType(T.BinaryType()))]), keep=["item_id"])
    counts = C.written(found.select("item_id", F.explode("terms").alias("term")).groupBy("item_id", "term")
                       .agg(F.count(F.lit(1)).alias("repeats")), "search-items")
    size = counts.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("item_id").alias("items")).first()
    n = max(1, -(-size["n"] // block_terms), -(-size["items"] // block_items))
    for block in range(n):
        ids: dict = {}
        postings: dict[bytes, list[tuple[int, int]]] = {}
        mine = counts.filter(F.pmod(F.xxhash64(F.coalesce("item_id", F.lit(0))), F.lit(n)) == block)
        for r in mine.orderBy("item_id", "term").toLocalIterator():
            postings.setdefault(bytes(r["term"]), []).append((ids.setdefault(r["item_id"], len(ids)), r["repeats"]))
        if ids:
            yield Index(list(ids), postings)


def _document_frequencies(docs: DataFrame, index: Index) -> None:
    """Weigh the index by counts over all documents (term -1: documents with a term, -2: all their terms)."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        index, df, n, total = shared.value, Counter(), 0, 0
        for batch in batches:
            for _, texts in C.chunks(batch.column(0)):
                for t in texts:
                    length, known = index.counts(t)
                    df.update(known.keys())
                    n, total = n + (length > 0), total + length
        df[-1], df[-2] = n, total
        yield pa.RecordBatch.from_arrays([pa.array(list(df), pa.int64()), pa.array(list(df.values()), pa.int64())], names=["term", "n"])

    found = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = {r["term"]: r["n"] for r in found.collect()}   # the block's terms
    index.weigh(df.pop(-1, 0), df.pop(-2, 0), df)


def _heaps(docs: DataFrame, index: Index, k: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        index = shared.value
        heaps = Heaps(len(index.items), k)
        most = max(1, CELLS // len(index.items))
        for batch in batches:
            ids = batch.column(0)
            for start, texts in C.chunks(batch.column(1)):
                rows = [(i, r) for i, r in zip(ids.slice(start, len(texts)).to_pylist(), map(index.counts, texts)) if r[1]]
                for a in range(0, len(rows), most):
                    part = rows[a:a + most]
                    heaps.offer([i for i, _ in part], index.scores([r for _, r in part]))
        out = [(item, None if d == _NO_ID else -d, s) for item, heap in zip(index.items, heaps.heaps) for s, d in heap]
        for a in range(0, len(out), 100_000):
            item, doc, score = zip(*out[a:a + 100_000])
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())],
                                             names=["item_id", "doc_id", "score"])

    return docs.mapInArrow(run, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text",
           block_terms: int = 2_000_000, block_items: int = 20_000) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    docs = C.id_and_text(docs, doc_col, text_col)
    path = scratch_table_path(spark, "search-heaps")
    spark.createDataFrame([], "item_id long, doc_id long, score long").write.parquet(path)
    for index in _blocks(items, block_terms, block_items, item_col, text_col):
        _document_frequencies(docs, index)
        if index.n_docs:
            _heaps(docs, index, k).write.mode("append").parquet(path)
    heaps = spark.read.schema("item_id long, doc_id long, score long").parquet(path)
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    merged = heaps.withColumn("salt", F.spark_partition_id() % MERGES) \
        .withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*best))).filter(F.col("rank") <= k)
    return merged.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*best))).filter(F.col("rank") <= k) \
        .select("item_id", "rank", "doc_id", "score")


def op11_reversed_search(spark, sf_dir: str) -> DataFrame:
    return search(C.read(spark, sf_dir, "documents"), C.read(spark, sf_dir, "benchmark"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
s AS (SELECT count(*) FILTER (len(terms) > 0) AS docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM d),
i AS (SELECT item_id, term, count(*) AS repeats FROM (
  SELECT item_id, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, term),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY r, doc_id, n, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, s GROUP BY term),
scored AS (SELECT item_id, r, doc_id,
    CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) AS BIGINT) AS score
  FROM i JOIN tf USING (term) JOIN w USING (term), s GROUP BY item_id, r, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20"""
