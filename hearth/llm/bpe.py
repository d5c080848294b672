"""Byte-level BPE encoding and decoding on padded matrices.

Pretokens are bucketed by length into padded matrices of ids.  In each round
every row merges its leftmost pair of least rank and closes the gap; rows
without a mergeable pair leave the matrix.  Pairs are looked up in an
open-addressing hash table held in numpy arrays.  Rows longer than
``LONG_ROW`` bytes merge every non-overlapping occurrence of their least pair
in one round, left to right, which ends in the same ids in far fewer rounds.

Defined results: a null or empty text has no ids; repeated rows repeat their
result; ids outside the vocabulary cannot be decoded (ValueError).
"""

from __future__ import annotations

import base64
import hashlib
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hearth.llm import _common as C
from hearth.llm._units import LIMIT, LONGEST, Pieces

NONE = np.int32(2**31 - 1)
LONG_ROW = 256


class Vocabulary:
    """Ranks of a byte-level BPE (a file of base64 tokens and ranks) and its pair table."""

    def __init__(self, ranks: bytes, pattern: str):
        import regex
        rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.rank, self.split = rank, regex.compile(pattern).findall
        self.size = max(rank.values()) + 1
        self.tokens: list[bytes | None] = [None] * self.size
        for token, r in rank.items():
            self.tokens[r] = token
        self.known: dict[str, bytes] = {}     # pretokens met before, at most LIMIT
        self.byte = np.array([rank[bytes([b])] for b in range(256)], np.int32)
        # every split of a token into two tokens is a pair that merges into it
        keys, values = [], []
        for token, r in rank.items():
            for i in range(1, len(token)):
                a, b = rank.get(token[:i]), rank.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a * self.size + b)
                    values.append(r)
        self._table(np.array(keys, np.int64), np.array(values, np.int32))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def _table(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Open addressing with linear probing, at most a quarter full."""
        self.bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 4))))
        size = 1 << self.bits
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, NONE, np.int32)
        slot, todo, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(todo):
            self.probes += 1
            at = slot[todo]
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[todo[free]]          # of several, one wins
            won = self.keys[at] == keys[todo]
            self.values[at[won]] = values[todo[won]]
            todo = todo[~won]
            slot[todo] = (slot[todo] + 1) & (size - 1)

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each merged pair, NONE where there is none (or a side is padding, -1)."""
        out = np.full(a.shape, NONE, np.int32).ravel()
        keys = (a.astype(np.int64) * self.size + b).ravel()
        todo = np.flatnonzero((a.ravel() >= 0) & (b.ravel() >= 0))
        slot, keys = self._slot(keys[todo]), keys[todo]
        for _ in range(self.probes):
            found = self.keys[slot]
            hit = found == keys
            out[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (found >= 0)
            if not on.any():
                break
            todo, keys, slot = todo[on], keys[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out.reshape(a.shape)

    # -- encoding -------------------------------------------------------

    def merge(self, ids: np.ndarray) -> list[bytes]:
        """Merge the rows of a padded matrix (padding -1) to the end; id bytes of each row."""
        out: list = [b""] * len(ids)
        own = np.arange(len(ids))

        def retire(rows, matrix):
            real = matrix >= 0
            flat = matrix[real].astype("<u4").tobytes()
            ends = (4 * np.cumsum(real.sum(1))).tolist()
            begin = 0
            for i, end in zip(rows.tolist(), ends):
                out[i], begin = flat[begin:end], end

        rank = self.pair_rank(ids[:, :-1], ids[:, 1:])
        while len(own) and rank.shape[1]:
            at = rank.argmin(1)                              # the leftmost of the least
            least = rank[np.arange(len(own)), at]
            over = least == NONE
            if over.any():
                retire(own[over], ids[over])
                on = ~over
                own, ids, rank, at, least = own[on], ids[on], rank[on], at[on], least[on]
                if not len(own):
                    return out
            r = np.arange(len(own))
            ids[r, at] = least
            keep = np.ones(ids.shape, bool)
            keep[r, at + 1] = False
            ids = ids[keep].reshape(len(own), -1)            # close the gap
            rank = rank[keep[:, 1:]].reshape(len(own), -1)   # the merged pair goes, its neighbours change
            some = at > 0
            rank[r[some], at[some] - 1] = self.pair_rank(ids[r[some], at[some] - 1], ids[r[some], at[some]])
            some = at < rank.shape[1]
            rank[r[some], at[some]] = self.pair_rank(ids[r[some], at[some]], ids[r[some], at[some] + 1])
        retire(own, ids)
        return out

    def merge_long(self, token: bytes) -> np.ndarray:
        """One long row: each round merges all occurrences of the least pair, left to right."""
        ids = self.byte[np.frombuffer(token, np.uint8)]
        while len(ids) > 1:
            rank = self.pair_rank(ids[:-1], ids[1:])
            least = rank.min()
            if least == NONE:
                break
            at = np.flatnonzero(rank == least)
            run = np.cumsum(np.append(0, np.diff(at) != 1))   # of touching occurrences every other one merges
            first = at[np.append(True, run[1:] != run[:-1])]
            at = at[(at - first[run]) % 2 == 0]
            ids = ids.copy()
            ids[at] = least
            ids = np.delete(ids, at + 1)
        return ids

    def encode_pretokens(self, tokens: list[bytes]) -> dict[bytes, bytes]:
        """Id bytes of distinct pretokens."""
        out: dict[bytes, bytes] = {}
        buckets: dict[int, list[bytes]] = {}
        for t in tokens:
            r = self.rank.get(t)
            if r is not None:
                out[t] = r.to_bytes(4, "little")
            elif len(t) > LONG_ROW:
                out[t] = self.merge_long(t).astype("<u4").tobytes()
            else:
                buckets.setdefault((len(t) + 3) // 4, []).append(t)
        for quarter, same in buckets.items():
            width, step = 4 * quarter, max(1, (1 << 18) // quarter)
            for i in range(0, len(same), step):
                some = same[i:i + step]
                raw = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in some), np.uint8).reshape(len(some), width)
                ids = self.byte[raw]
                ids[np.arange(width) >= np.array([len(t) for t in some])[:, None]] = -1
                out.update(zip(some, self.merge(ids)))
        return out

    def pretokens(self, texts: list[str]) -> list[list[str]]:
        """Each text's pretokens.  Texts that begin with a space and end with
        none can stand in a row without a change of their cuts: one scan."""
        row = [t for t in texts if t[:1] == " " and not t[-1].isspace()]
        found, at, cuts = self.split("".join(row)), 0, []
        for t in texts:
            if t[:1] == " " and not t[-1].isspace():
                n, begin = len(t), at
                while n:
                    n -= len(found[at])
                    at += 1
                cuts.append(found[begin:at])
            else:
                cuts.append(self.split(t))
        return cuts

    def encode(self, texts: list[str]) -> list[bytes]:
        """Id bytes of each text, whatever it holds."""
        cuts = self.pretokens(texts)
        known = self.known
        new = list({p for parts in cuts for p in parts if p not in known})
        raw = [p.encode("utf-8", "surrogatepass") for p in new]
        ids = self.encode_pretokens(raw)
        now = {p: ids[x] for p, x in zip(new, raw)}
        out = [b"".join([known.get(p) or now[p] for p in parts]) for parts in cuts]
        if len(known) + len(now) > LIMIT:
            known.clear()
        known.update((p, b) for p, b in now.items() if len(p) <= LONGEST)
        return out

    def decode(self, ids: bytes) -> bytes:
        """The bytes that id bytes stand for."""
        parts = [self.tokens[i] if i < self.size else None for i in np.frombuffer(ids, "<u4").tolist()]
        if None in parts:
            raise ValueError("an id outside the vocabulary")
        return b"".join(parts)


_WORKER: dict = {}


def _worker(ranks: bytes, pattern: str) -> tuple[Vocabulary, Pieces]:
    key = (hash(ranks), pattern)
    if _WORKER.get("key") != key:
        v = Vocabulary(ranks, pattern)
        _WORKER.update(key=key, both=(v, Pieces(v.encode)))
    return _WORKER["both"]


def _forget() -> None:
    """Empty the worker's memory of pieces."""
    if "both" in _WORKER:
        for part in _WORKER["both"]:
            part.known.clear()


def encode(docs: DataFrame, ranks_path: str, pattern: str, out_col: str = "ids", text_col: str = "text",
           keep: list[str] | None = None) -> DataFrame:
    """Append ``out_col``: the ids of each whole text as little-endian unsigned 32-bit bytes."""
    ranks = docs.sparkSession.sparkContext.broadcast(Path(ranks_path).read_bytes())     # one fixed file
    return C.map_text(docs, lambda texts: [_worker(ranks.value, pattern)[1].texts(texts)],
                      T.StructType([T.StructField(out_col, T.BinaryType())]), text_col, keep, _forget)


def op3_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as P
    ranks = spark.sparkContext.broadcast(Path(P.path("byte_bpe_multi_50k.tiktoken")).read_bytes())   # one fixed file
    pattern = P.PATTERN

    def both(texts):
        vocabulary, pieces = _worker(ranks.value, pattern)
        out: list[list] = [[], [], []]
        for ids in pieces.texts(texts):
            out[0].append(len(ids) // 4)
            out[1].append(hashlib.sha256(ids).hexdigest())
            out[2].append(hashlib.sha256(vocabulary.decode(ids)).hexdigest())
        return out

    return C.map_text(C.read(spark, sf_dir, "documents"), both, T.StructType([
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType())]), keep=["doc_id"], done=_forget)
