"""Source divergence audit: which sources of a language use its words unlike the others, and which words.

First pass: exact document frequencies of (lang, term); terms in at least
``min_docs`` documents of a language are kept.  The kept terms are cut into
shards of about a megabyte by hash, and Spark builds a minimal perfect hash of
each shard in its own task: levels of bit arrays in which a key takes the slot
of its rank among the bits that exactly one key sets, and the keys themselves
in slot order.  Second pass: the perfect hashes are broadcast and a task counts
terms in dense arrays, one per (lang, source, shard); a lookup counts only if
the stored key equals the term.

At most ``round_bytes`` of shards are broadcast at once: a larger vocabulary
takes several rounds over the documents.  Dense arrays hold at most ``CELLS``
counters in a task and are emptied into rows when they are full.

A group's shares and the divergence are integers (exact).  Terms of a hot
group are spread over the shards; pairs of sources are summed over blocks of
slots and tiles of sources, never by a join of a term's rows.

Defined results: null text, lang and source are empty text; a document without
terms still makes its group occur; a language without kept terms gives only
``pair`` rows of value 0; a language with one source gives no ``pair`` rows;
repeated rows are separate documents; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm import _common as C
from hearth.session import scratch_table_path

# ASCII that is no letter separates terms; only A-Z are lower-cased
_TO_TERMS = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalpha() else 32 for c in range(256))

SHARD_BYTES = 1 << 20     # kept terms of a shard, with 16 bytes each for its hash
ROUND_BYTES = 64 << 20    # shards broadcast at once
CELLS = 8_000_000         # dense counters of a task
SEEN = 400_000            # distinct terms a task counts before it hands them on
SLOTS, TILE = 4_096, 256  # slots of a block and sources of a tile when pairs are compared
SALTS = 32                # join keys of a language
LEVELS = 32


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_TO_TERMS).split()


def _hashes(keys: list[bytes]) -> np.ndarray:
    """XXH64 with seed 42: the value of Spark's ``xxhash64`` on the same string."""
    return np.fromiter((xxhash.xxh64_intdigest(k, 42) for k in keys), np.uint64, len(keys))


def _mixed(h: np.ndarray, level: int) -> np.ndarray:
    x = h + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of one shard, with its keys in slot order.

    ``words``: the bits of all levels; ``sizes``: bits of each level.  Keys that
    no level separates (equal 64-bit hashes) take the last slots and are found
    by comparing keys."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, offsets: np.ndarray, keys: bytes):
        self.words, self.sizes, self.offsets, self.keys = words, sizes, offsets, keys
        counts = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(counts) - counts
        self.n, placed = len(offsets) - 1, int(counts.sum())
        self.rest = {self.key(i): i for i in range(placed, self.n)}

    def key(self, slot: int) -> bytes:
        return self.keys[self.offsets[slot]:self.offsets[slot + 1]]

    @classmethod
    def build(cls, keys: list[bytes]) -> PerfectHash:
        hashes, left = _hashes(keys), np.arange(len(keys))
        bits, order, sizes = [], [], []
        for level in range(LEVELS):
            if not len(left):
                break
            size = -(-3 * len(left) // 128) * 64
            at = (_mixed(hashes[left], level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            mine = alone[at]
            order.append(left[mine][np.argsort(at[mine])])
            bits.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            left = left[~mine]
        order = np.concatenate([*order, left]).astype(np.int64)
        placed = [keys[i] for i in order]
        return cls(np.concatenate([*bits, np.zeros(0, np.uint64)]).astype(np.uint64), np.array(sizes, np.int64),
                   np.concatenate([[0], np.cumsum([len(k) for k in placed])]).astype(np.int64), b"".join(placed))

    def slots(self, keys: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 if it is not one of the shard's."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = (_mixed(hashes[left], level) % np.uint64(size)).astype(np.int64) + base
            word, bit = self.words[at >> 6], np.uint64(1) << (at & 63).astype(np.uint64)
            hit = (word & bit) != 0
            rank = self.before[at >> 6] + np.bitwise_count(word & (bit - np.uint64(1)))
            out[left[hit]] = rank[hit]
            left, base = left[~hit], base + size
        offsets, stored = self.offsets.tolist(), self.keys
        for i, s in enumerate(out.tolist()):
            if s < 0:
                out[i] = self.rest.get(keys[i], -1)
            elif stored[offsets[s]:offsets[s + 1]] != keys[i]:
                out[i] = self.rest.get(keys[i], -1) if self.rest else -1
        return out


def _rows(columns, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns], names=names)


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """lang, term: terms that at least ``min_docs`` documents of the language hold (exact)."""
    def run(batches):
        seen: dict[str, Counter] = {}

        def out():
            langs = [lang for lang, c in seen.items() for _ in c]
            found = pa.array([t for c in seen.values() for t in c], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), found,
                                               pa.array([n for c in seen.values() for n in c.values()], pa.int64())], names=["lang", "term", "n"])
        for batch in batches:
            langs = batch.column(0)
            for start, texts in C.chunks(batch.column(1)):
                for lang, t in zip(langs.slice(start, len(texts)).to_pylist(), texts):
                    seen.setdefault(lang, Counter()).update(set(terms(t)))
                if sum(map(len, seen.values())) > SEEN:
                    yield out()
                    seen = {}
        yield out()

    return docs.select("lang", "text").mapInArrow(run, "lang string, term string, n long") \
        .groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs).select("lang", "term")


def _joined_by_lang(df: DataFrame, per_lang: DataFrame, *spread: str) -> DataFrame:
    """``df`` with the rows of ``per_lang`` of its language.  A language may hold
    most rows: its rows of ``df`` are dealt by ``spread`` to ``SALTS`` join keys."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return df.withColumn("salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")) \
        .join(per_lang.withColumn("salt", salts), ["lang", "salt"]).drop("salt")


def perfect_hashes(kept: DataFrame) -> DataFrame:
    """One row a shard: its perfect hash and its keys (``shards``: how many the language has)."""
    salted = kept.groupBy("lang", F.pmod(F.xxhash64("term"), F.lit(SALTS)).alias("salt")).agg(F.sum(F.octet_length("term") + 16).alias("bytes"))
    sizes = salted.groupBy("lang").agg(F.ceil(F.sum("bytes") / SHARD_BYTES).alias("shards"))
    dealt = _joined_by_lang(kept, sizes, "term").withColumn("shard", F.pmod(F.xxhash64("term"), "shards")).repartition("lang", "shard")

    def build(key, pdf):
        h = PerfectHash.build(sorted(t.encode() for t in pdf["term"]))
        return pd.DataFrame({"lang": [key[0]], "shard": [key[1]], "shards": [int(pdf["shards"].iloc[0])], "n": [h.n], "words": [h.words.tobytes()],
                             "sizes": [h.sizes.tobytes()], "offsets": [h.offsets.tobytes()], "keys": [h.keys]})

    return dealt.groupBy("lang", "shard").applyInPandas(build, "lang string, shard long, shards long, n long, words binary, sizes binary, offsets binary, keys binary")


def _opened(row) -> PerfectHash:
    return PerfectHash(np.frombuffer(row["words"], np.uint64), np.frombuffer(row["sizes"], np.int64),
                       np.frombuffer(row["offsets"], np.int64), bytes(row["keys"]))


def _terms_by_slot(hashes: DataFrame) -> DataFrame:
    def run(frames):
        for pdf in frames:
            for _, r in pdf.iterrows():
                h = _opened(r)
                yield pd.DataFrame({"lang": r["lang"], "shard": r["shard"], "slot": np.arange(h.n),
                                    "term": [h.key(i).decode() for i in range(h.n)]})

    return hashes.select("lang", "shard", "words", "sizes", "offsets", "keys").mapInPandas(run, "lang string, shard long, slot long, term string")


def _rounds(hashes: DataFrame, round_bytes: int):
    """The shards of each round as {(lang, shard): row}, and how many shards each language has."""
    sized = hashes.select("lang", "shard", "shards", (F.octet_length("words") + F.octet_length("offsets") + F.octet_length("keys")).alias("bytes"))
    listed = sized.orderBy("lang", "shard").collect()   # one row a megabyte of kept terms
    shards = {r["lang"]: r["shards"] for r in listed}
    rounds, used = [[]], 0
    for r in listed:
        if rounds[-1] and used + r["bytes"] > round_bytes:
            rounds.append([])
            used = 0
        rounds[-1].append((r["lang"], r["shard"]))
        used += r["bytes"]
    for keys in rounds:
        first, last = keys[:1], keys[-1:]
        if first:
            at = F.struct("lang", "shard")
            mine = hashes.filter(at.between(F.struct(F.lit(first[0][0]), F.lit(first[0][1]).cast("long")),
                                            F.struct(F.lit(last[0][0]), F.lit(last[0][1]).cast("long"))))
            yield shards, [r.asDict() for r in mine.select("lang", "shard", "words", "sizes", "offsets", "keys").collect()]


def counted(docs: DataFrame, shards: dict[str, int], rows: list[dict]) -> DataFrame:
    """lang, source, shard, slot, n: occurrences of the kept terms of one round's shards (partial sums)."""
    shared = docs.sparkSession.sparkContext.broadcast((shards, rows))

    def run(batches):
        shards, rows = shared.value
        hashes = {(r["lang"], r["shard"]): _opened(r) for r in rows}
        dense: dict[tuple[str, str, int], np.ndarray] = {}

        def out():
            for (lang, source, shard), counts in dense.items():
                at = np.flatnonzero(counts)
                yield _rows([([lang] * len(at), pa.string()), ([source] * len(at), pa.string()), (np.full(len(at), shard), pa.int64()),
                             (at, pa.int64()), (counts[at], pa.int64())], ["lang", "source", "shard", "slot", "n"])

        def add(lang, by_source):
            """Count the terms of some documents of a language, given as {source: terms}."""
            codes, found = pd.factorize(np.array([t for ts in by_source.values() for t in ts], dtype=object))
            found = list(found)
            hashed = _hashes(found)
            shard_of = hashed.view(np.int64) % np.int64(shards[lang])
            slot_of = np.full(len(found), -1, dtype=np.int64)
            for s in np.unique(shard_of):
                if (lang, int(s)) in hashes:
                    at = np.flatnonzero(shard_of == s)
                    slot_of[at] = hashes[lang, int(s)].slots([found[i] for i in at], hashed[at])
            start = 0
            for source, ts in by_source.items():
                mine = codes[start:start + len(ts)]
                start += len(ts)
                slots, of = slot_of[mine], shard_of[mine]
                for s in np.unique(of[slots >= 0]).tolist():
                    if (lang, source, s) not in dense:
                        dense[lang, source, s] = np.zeros(hashes[lang, s].n, dtype=np.int64)
                    np.add.at(dense[lang, source, s], slots[(of == s) & (slots >= 0)], 1)

        for batch in batches:
            langs, sources = batch.column(0), batch.column(1)
            for start, texts in C.chunks(batch.column(2)):
                groups: dict[str, dict[str, list]] = {}
                for lang, source, t in zip(langs.slice(start, len(texts)).to_pylist(), sources.slice(start, len(texts)).to_pylist(), texts):
                    if lang in shards:
                        groups.setdefault(lang, {}).setdefault(source, []).extend(terms(t))
                for lang, by_source in groups.items():
                    if any(by_source.values()):
                        add(lang, by_source)
                if sum(map(len, dense.values())) > CELLS:
                    yield from out()
                    dense = {}
        yield from out()

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, shard long, slot long, n long")


def _share(n: str, total: str, kept: str) -> F.Column:
    """p of a count: one more than a thousand million of (n + 2) over (total + 2 kept), rounded down."""
    return F.expr(f"1 + CAST(1000000000 AS DECIMAL(10,0)) * CAST({n} + 2 AS DECIMAL(20,0)) div CAST({total} + 2 * {kept} AS DECIMAL(20,0))")


_DIVERGENCE = "(p - q) * (p - q) div (p + q)"


def _pair_sums(cells: DataFrame, sources: DataFrame, hashes: DataFrame) -> DataFrame:
    """lang, a, b, value for places a < b of two sources of a language: the divergence summed over all kept terms.

    A task gets one block of slots and one pair of tiles of sources; a source's
    share at a slot where it has no count is the same everywhere (``p0``)."""
    blocks = sources.select("lang").distinct().join(hashes.select("lang", "shard", "n"), "lang", "left") \
        .select("lang", F.coalesce("shard", F.lit(-1).cast("long")).alias("shard"), F.coalesce("n", F.lit(0).cast("long")).alias("n")) \
        .select("lang", "shard", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.greatest(F.col("n") - 1, F.lit(0)) / SLOTS))).alias("block")) \
        .select("lang", "shard", "block", F.least(F.lit(SLOTS), F.col("n") - F.col("block") * SLOTS).alias("width"))

    def in_tiles(df):
        tile = (F.col("place") / TILE).cast("long")
        return df.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles")))) \
            .withColumn("ta", F.least(tile, F.col("other"))).withColumn("tb", F.greatest(tile, F.col("other"))).drop("tiles", "other")

    left = in_tiles(cells.withColumn("block", F.floor(F.col("slot") / SLOTS)).withColumn("slot", F.col("slot") % SLOTS)
                    .select("lang", "shard", "block", "place", "slot", "p", "tiles"))
    right = _joined_by_lang(blocks, in_tiles(sources.select("lang", "place", "p0", "tiles")), "shard", "block") \
        .select("lang", "shard", "block", "ta", "tb", "place", "p0", "width")

    def compare(key, cells, groups):
        groups = groups.sort_values("place")
        places, width = groups["place"].to_numpy(), int(groups["width"].iloc[0])
        p = np.repeat(groups["p0"].to_numpy(dtype=np.int64)[:, None], width, axis=1)
        if len(cells):
            p[np.searchsorted(places, cells["place"].to_numpy()), cells["slot"].to_numpy()] = cells["p"].to_numpy()
        ta, tb = key[3], key[4]
        tile, found = places // TILE, [(np.zeros(0, np.int64),) * 3]
        for i in np.flatnonzero(tile == ta):
            others = np.flatnonzero((tile == tb) & (places > places[i]))
            if len(others):
                d = p[others] - p[i]
                found.append((np.full(len(others), places[i]), places[others], (d * d // (p[others] + p[i])).sum(axis=1)))
        a, b, value = (np.concatenate(column) for column in zip(*found))
        return pd.DataFrame({"lang": np.full(len(a), key[0], dtype=object), "a": a, "b": b, "value": value})

    keys = ["lang", "shard", "block", "ta", "tb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "lang string, a long, b long, value long") \
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          round_bytes: int = ROUND_BYTES) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from each
    other of its language (``pair``) and the terms it uses beyond the language's
    share (``term``, at most ``top``)."""
    spark = docs.sparkSession
    C.ship_package(spark)
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                         for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    hashes = C.written(perfect_hashes(C.written(kept_terms(docs, min_docs), "divergence-kept")), "divergence-hashes")
    path = scratch_table_path(spark, "divergence-counts")
    schema = "lang string, source string, shard long, slot long, n long"
    spark.createDataFrame([], schema).write.parquet(path)
    for shards, rows in _rounds(hashes, round_bytes):
        counted(docs, shards, rows).groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n")).write.mode("append").parquet(path)
    counts = spark.read.schema(schema).parquet(path)

    kept = hashes.groupBy("lang").agg(F.sum("n").alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(kept, "lang", "left") \
        .select("lang", "source", F.coalesce("total", F.lit(0).cast("long")).alias("total"), F.coalesce("kept", F.lit(0).cast("long")).alias("kept"),
                (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long").alias("place"))
    lang = Window.partitionBy("lang")   # a row a source
    sources = C.written(sources.withColumn("p0", F.when(F.col("kept") > 0, _share("0", "total", "kept")).otherwise(1))
                        .withColumn("lang_total", F.sum("total").over(lang)).withColumn("tiles", F.floor(F.max("place").over(lang) / TILE)),
                        "divergence-sources")
    cells = C.written(counts.join(sources, ["lang", "source"]).select("lang", "source", "place", "shard", "slot", "n", "lang_total", "kept", "tiles",
                                                                      _share("n", "total", "kept").alias("p")), "divergence-cells")

    sums = _pair_sums(cells, sources, hashes)
    name = sources.select("lang", F.col("place").alias("a"), "source")
    other = sources.select("lang", F.col("place").alias("b"), F.col("source").alias("item"))
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    pairs = both.join(name, ["lang", "a"]).join(other, ["lang", "b"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    usual = cells.groupBy("lang", "shard", "slot").agg(F.sum("n").alias("n"), F.first("lang_total").alias("total"), F.first("kept").alias("kept")) \
        .select("lang", "shard", "slot", _share("n", "total", "kept").alias("q"))
    told = cells.join(usual, ["lang", "shard", "slot"]).filter("p > q").join(_terms_by_slot(hashes), ["lang", "shard", "slot"]) \
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_DIVERGENCE).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    told = told.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(told).select("lang", "source", "part", "item", "value", "rank")


def op13_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(C.read(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
t AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n,
    CAST(1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (total + 2 * v) AS BIGINT) AS p
  FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
l AS (SELECT lang, term, CAST(1 + (1000000000::HUGEINT * (sum(n) + 2)) // (any_value(w.total) + 2 * any_value(v)) AS BIGINT) AS q
  FROM p JOIN v USING (lang) JOIN (SELECT lang, sum(total) AS total FROM g GROUP BY lang) w USING (lang) GROUP BY lang, term),
f AS (SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
told AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
  FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM told))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10"""
