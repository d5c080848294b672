"""Packing by concatenate and cut.

The documents' ids (each document ends with one separator id) form one long
stream in the order in which the tokenised table is written: files in task
order, rows as they stand in their file.  Pass one stores every document's ids
with its place within its task and sums each task's ids; the running sum over
these totals -- one row for each task -- gives every document its global
offset.  Pass two cuts the stream into windows of ``capacity`` ids; a document
that crosses a border leaves one record on either side.  Every sequence but
the last is full, so at most ``capacity - 1`` places are padding in all.

Defined results: a null or empty text is its separator alone; repeated rows
and null ids are packed as they come; an empty table gives no sequence.
"""

from __future__ import annotations

import base64
import json
import re
from array import array
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm import _common as C
from hearth.llm._units import stretches

_WORKER: dict = {}


def added_tokens(json_path: str) -> dict[str, int]:
    """The added tokens of a tokenizer file: text and id.  Those that match
    only as whole words, or take in spaces, are not built."""
    with open(json_path, encoding="utf-8") as f:
        found = json.load(f).get("added_tokens", [])
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in found):
        raise ValueError("an added token that matches only as a word or takes in spaces")
    return {t["content"]: t["id"] for t in found}


class Tokenizer:
    """Whole texts to id bytes: an added token is its id, what stands between is encoded alone."""

    def __init__(self, ranks: bytes, pattern: str, added: dict[str, int]):
        import tiktoken
        rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=rank, special_tokens={}).encode_ordinary
        self.added = {t: np.array([i], "<u4").tobytes() for t, i in added.items()}
        # the longest first, where one begins another
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

    def plain(self, text: str) -> bytes:
        """Id bytes of a text without added tokens.  The library encodes a text in one call faster than its words are
        looked up one by one; only a very long text is cut, so that its ids do not all stand in one list."""
        return b"".join([array("I", self.encode(part)).tobytes() for part in stretches(text)])

    def texts(self, texts: list[str]) -> list[bytes]:
        """Id bytes of every text."""
        out = []
        for t in texts:
            if any(a in t for a in self.added):                   # text, token, text, token, ..., text
                out.append(b"".join([self.added[p] if k % 2 else self.plain(p) for k, p in enumerate(self.cut.split(t))]))
            else:
                out.append(self.plain(t))
        return out


def _tokenizer(ranks: bytes, pattern: str, added: dict[str, int]) -> Tokenizer:
    """The worker's tokenizer for a rank file's content."""
    key = (hash(ranks), pattern, tuple(added.items()))
    if _WORKER.get("key") != key:
        _WORKER.update(key=key, tokenizer=Tokenizer(ranks, pattern, added))
    return _WORKER["tokenizer"]


def tokenised(docs: DataFrame, ranks_path: str, pattern: str, separator: int = 0, id_col: str = "doc_id",
              text_col: str = "text", added: dict[str, int] | None = None) -> DataFrame:
    """Pass one, as a written table: (id, part, before, n, ids): the task that
    wrote the row, how many ids stand before it there, its own count and ids
    (little-endian unsigned 32-bit).  ``added``: texts that are one id, wherever they stand."""
    added = added or {}
    df = C.id_and_text(docs, id_col, text_col)
    ranks = df.sparkSession.sparkContext.broadcast(Path(ranks_path).read_bytes())   # one fixed file
    tail = np.array([separator], "<u4").tobytes()
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("part", T.IntegerType()),
                           T.StructField("before", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("ids", T.BinaryType())])

    def run(batches):
        tokenizer, part, before = _tokenizer(ranks.value, pattern, added), TaskContext.get().partitionId(), 0
        for batch in batches:
            for start, texts in C.chunks(batch.column(1)):
                ids = [x + tail for x in tokenizer.texts(texts)]
                n = np.array([len(x) // 4 for x in ids], np.int64)
                at = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(ids)), pa.array(np.full(len(ids), part, np.int32)), pa.array(at),
                     pa.array(n), pa.array(ids, pa.binary())], names=["id", "part", "before", "n", "ids"])
        C.let_go()

    return C.written(df.mapInArrow(run, schema), "packing-ids")


def pack(tokens: DataFrame, capacity: int = 1024) -> DataFrame:
    """Pass two.  ``tokens`` as ``tokenised`` returns it.  One row per piece:
    (id, start, length, ids, doc_tokens, sequence_id, offset)."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))     # one row per task
    offsets = totals.withColumn("base", F.coalesce(F.sum("total").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "base")
    placed = tokens.join(F.broadcast(offsets), "part").select("id", (F.col("base") + F.col("before")).alias("at"), "n", "ids")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
                           T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def run(batches):
        for batch in batches:
            at, n = (batch.column(i).to_numpy() for i in (1, 2))
            k = (at + n - 1) // capacity - at // capacity + 1              # pieces of each document
            row = np.repeat(np.arange(len(n)), k)
            window = np.repeat(at // capacity, k) + np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
            begin = np.maximum(at[row], window * capacity)
            end = np.minimum((at + n)[row], (window + 1) * capacity)
            start, length = begin - at[row], end - begin
            for i in range(0, len(row), 4096):
                own = {r: memoryview(batch.column(3)[r].as_buffer()) for r in np.unique(row[i:i + 4096]).tolist()}
                cut = [bytes(own[r][4 * s:4 * (s + m)]) for r, s, m in zip(row[i:i + 4096].tolist(), start[i:i + 4096].tolist(), length[i:i + 4096].tolist())]
                one = slice(i, i + len(cut))
                yield pa.RecordBatch.from_arrays(
                    [pc.take(batch.column(0), pa.array(row[one])), pa.array(start[one]), pa.array(length[one]),
                     pa.array(cut, pa.binary()), pa.array(n[row[one]]), pa.array(window[one]),
                     pa.array((begin - window * capacity)[one])], names=schema.names)

    return placed.mapInArrow(run, schema)


def _digest(pieces: DataFrame) -> DataFrame:
    """The contract's columns; crc32 is Spark's own function over the piece's id bytes."""
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return packed_documents(spark, C.read(spark, sf_dir, "documents"), sf_dir)


def packed_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of the packed sequences."""
    import public_tokenizers as P
    # the vocabulary of byte_bpe_50k.json as ranks: the same ids (a test compares the two)
    return _digest(pack(tokenised(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, added=added_tokens(P.path("byte_bpe_50k.json")))))
