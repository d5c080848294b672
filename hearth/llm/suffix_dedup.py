"""Suffix-array dedup: remove bytes covered by a string of ``length`` bytes that starts anywhere else too.

1. Anchors.  Every window of ``length`` bytes selects the k-gram of least hash
   in it (the first of equals).  The choice depends on the window's bytes only,
   so equal windows anywhere select equal k-grams at the same place in them.
   Consecutive windows that select one k-gram form a context.  Windows can be
   equal only if their contexts' anchors are.
2. Equal contexts with equal anchors are counted before anything else moves;
   one of each stands for all.  Anchors that occur once end here.
   An anchor with one kind of context, found at several places, repeats as a
   whole: all its windows are equal pairwise.
3. Shard arrays.  The distinct contexts of an anchor form one string.  Its
   suffix array is made by induced sorting (``suffix_sort``: classify suffixes,
   sort the leftmost-smaller substrings recursively, induce), and the permuted
   common prefixes give the runs of suffixes that share ``length`` bytes.  A
   run that stands for two or more places repeats.
   An anchor with more than ``block_contexts`` kinds first gets longer: each of
   its contexts is cut into ``REFINE`` parts by how far a window reaches back
   from the anchor, and all windows of a part share far more bytes, which name
   its new group.  Groups that are still large are dealt to blocks of about
   ``block_contexts``; each block returns one digest of each of its runs, and
   runs with equal 128-bit digests are added up across blocks.  So no task has
   to hold a hot anchor.
4. Repeated windows go back to all contexts they stand for and are merged to
   spans document by document.

All passes cover whole texts; there is no cap on contexts, places or spans.

Defined results: a null or empty text has no bytes and no spans; rows that
repeat an id and text repeat each other (their text is removed where it has
``length`` bytes); rows that share an id but not a text are separate texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm import _common as C
from hearth.llm.suffix_sort import permuted_prefixes, suffix_arrays

KGRAM, REFINE = 32, 4
PASSAGE_BYTES = 200   # the pipeline stage's length; a passage of over 50 very short words can lie below it
DOCS = 64             # documents a task works on at once
_BYTE = np.random.default_rng(42).integers(1, 2**63, 256, dtype=np.uint64)   # a random value for each byte
_STEP = 0x9E3779B97F4A7C15


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Mixed 64-bit hash of every KGRAM bytes."""
    h, power, m = _BYTE[data], _STEP, 1
    while m < KGRAM:
        h = h[:-m] * np.uint64(power) + h[m:]
        power, m = power * power % 2**64, 2 * m
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: prefix and suffix minima of blocks."""
    n = len(x) - width + 1
    pad = -len(x) % width
    blocks = np.append(x, np.full(pad, np.uint64(0xFFFFFFFFFFFFFFFF))).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def contexts(texts: list[bytes], length: int):
    """(text, anchor hash, context digest, first byte, bytes, the anchor's byte) of every context, as arrays."""
    digest = xxhash.xxh3_64_intdigest
    width = length - KGRAM + 1
    long = [i for i, t in enumerate(texts) if len(t) >= length]
    if not long:
        return [np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int32, np.int32, np.int32)]
    data = b"".join(texts[i] for i in long)
    sizes = np.array([len(texts[i]) for i in long])
    begins = np.cumsum(sizes) - sizes
    h = _gram_hashes(np.frombuffer(data, np.uint8))
    chosen = _least((h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64), width) & np.uint64(0xFFFFFFFF)
    windows = sizes - length + 1
    first = np.repeat(begins - (np.cumsum(windows) - windows), windows)
    at = first + np.arange(int(windows.sum()))               # windows inside one text
    own = np.repeat(np.arange(len(long)), windows)
    chosen = chosen[at]
    new = np.flatnonzero(np.append(True, (chosen[1:] != chosen[:-1]) | (own[1:] != own[:-1])))
    last = np.append(new[1:], len(at)) - 1
    begin, end = at[new], at[last] + length
    ctx = np.array([digest(data[a:b]) for a, b in zip(begin.tolist(), end.tolist())], np.uint64).view(np.int64)
    return [np.array(long)[own[new]], h[chosen[new].astype(np.int64)].view(np.int64), ctx,
            (begin - begins[own[new]]).astype(np.int32), (end - begin).astype(np.int32),
            (chosen[new].astype(np.int64) - begins[own[new]]).astype(np.int32)]


def refined(data: bytes, anchor: int, length: int):
    """(group, digest, first byte, bytes) of the parts of one context: windows
    that reach back from the anchor alike share ``length`` - reach / REFINE bytes around it."""
    out, reach = [], length - KGRAM
    step = -(-reach // REFINE)
    windows = len(data) - length + 1
    for j in range(REFINE):
        # windows that begin step * j .. step * (j + 1) - 1 bytes before the anchor
        a, b = max(anchor - step * (j + 1) + 1, 0), min(anchor - step * j, windows - 1)
        if a <= b:
            back, ahead = step * j, max(reach - step * (j + 1) + 1, 0)
            shared = data[anchor - back:anchor + KGRAM + ahead]
            out.append((xxhash.xxh3_64_intdigest(shared, seed=j + 1), xxhash.xxh3_64_intdigest(data[a:b + length]), a, b + length - a))
    return out


def _utf8(texts: list[str]) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts]


def _find(docs: DataFrame, length: int) -> DataFrame:
    """(id, th, fp, ctx, at, n) of every context of every row."""
    schema = "id long, th long, fp long, ctx long, at int, n int"

    def run(batches):
        for batch in batches:
            for start, texts in C.chunks(batch.column(2), 1 << 18):
                row, fp, ctx, at, n, _ = contexts(_utf8(texts), length)
                row = pa.array(row + start)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(fp), pa.array(ctx),
                                                  pa.array(at), pa.array(n)], names=["id", "th", "fp", "ctx", "at", "n"])
        C.let_go()

    return docs.mapInArrow(run, schema)


def solve(groups: np.ndarray, counts: np.ndarray, texts: list[bytes], length: int):
    """Contexts sorted by group.  Returns context, first byte and run of every
    window, and each run's number of places."""
    heads = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    per = np.diff(np.append(heads, len(groups)))
    sizes = np.array([len(t) for t in texts])
    lengths = np.add.reduceat(sizes, heads) + per + 1
    rank = np.argsort(-lengths, kind="stable")               # one string for each group, longest first
    lengths, per = lengths[rank], per[rank]
    before = np.cumsum(per) - per
    place = np.arange(len(texts)) - np.repeat(before, per)   # a context's place in its string
    take = np.repeat(heads[rank], per) + place
    closes = place == np.repeat(per, per) - 1
    # letters: 0 ends the string, 1.. end its contexts, then the bytes
    shift = int(per.max()) + 1
    parts = []
    for i, k, last in zip(take.tolist(), place.tolist(), closes.tolist()):
        parts += [np.frombuffer(texts[i], np.uint8).astype(np.uint16) + np.uint16(shift),
                  np.array([k + 1, 0] if last else [k + 1], np.uint16)]
    s = np.concatenate(parts)
    begin = np.cumsum(lengths) - lengths
    own = sizes[take]
    stands = np.cumsum(own + 1 + closes) - (own + 1 + closes)
    sa = suffix_arrays(s.astype(np.int64), begin, lengths, np.full(len(lengths), shift + 256, np.int64))
    plcp = permuted_prefixes(s, sa, begin)
    run = np.cumsum(plcp[sa] < length)
    ctx = np.searchsorted(stands, sa, "right") - 1
    start = sa - stands[ctx]
    window = start <= own[ctx] - length
    ctx, start, run = take[ctx[window]], start[window], run[window]
    _, run = np.unique(run, return_inverse=True)
    return ctx, start, run, np.bincount(run, counts[ctx]).astype(np.int64)


def _shards(wanted: DataFrame, length: int, letters: int) -> DataFrame:
    """``wanted`` (fp, block, blocks, ctx, places, bytes).  Returns (fp, ctx,
    first, last, places, h1, h2): window starts first..last of a context that
    repeat (h1 null), or one run of a block of several: its window, number of
    places and digest."""
    schema = "fp long, ctx long, first int, last int, places long, h1 long, h2 long"
    dealt = wanted.repartition("fp", "block").sortWithinPartitions("fp", "block", "ctx")

    def answer(rows):
        fp, block, blocks, ctx, places, texts = rows
        group = np.cumsum(np.append(False, (fp[1:] != fp[:-1]) | (block[1:] != block[:-1])))
        c, start, run, total = solve(group, places, texts, length)
        order = np.lexsort((start, c))
        c, start, run = c[order], start[order], run[order]
        several = blocks[c] > 1
        again = (total[run] >= 2) & ~several
        # neighbouring repeated windows of a context as one row
        rc, rs = c[again], start[again]
        new = np.append(True, (rc[1:] != rc[:-1]) | (rs[1:] != rs[:-1] + 1))[:len(rc)]
        f = np.flatnonzero(new)
        l = np.append(f[1:], len(rc)) - 1
        out = [fp[rc[f]], ctx[rc[f]], rs[f], rs[l] if len(f) else rs[:0]]
        hc, hs, hr = c[several], start[several], run[several]
        digests = np.frombuffer(b"".join(hashlib.blake2b(texts[i][a:a + length], digest_size=16).digest()
                                         for i, a in zip(hc.tolist(), hs.tolist())), np.int64).reshape(-1, 2)
        # a run's places are counted once: with its first window
        once = np.zeros(len(hr), np.int64)
        _, at = np.unique(hr, return_index=True)
        once[at] = total[hr[at]]
        k, m = len(out[0]), len(hc)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([out[0], fp[hc]])), pa.array(np.concatenate([out[1], ctx[hc]])),
             pa.array(np.concatenate([out[2], hs]).astype(np.int32)), pa.array(np.concatenate([out[3], hs]).astype(np.int32)),
             pa.array(np.concatenate([np.zeros(k, np.int64), once])),
             pa.array(np.concatenate([np.zeros(k, np.int64), digests[:, 0]]), mask=np.arange(k + m) < k),
             pa.array(np.concatenate([np.zeros(k, np.int64), digests[:, 1]]), mask=np.arange(k + m) < k)],
            names=["fp", "ctx", "first", "last", "places", "h1", "h2"])

    def run(batches):
        held, used = [], 0

        def joined(parts):
            return [np.concatenate([p[i] for p in parts]) for i in range(5)] + [[t for p in parts for t in p[5]]]

        def cut(rows, a, b):
            return [x[a:b] for x in rows]

        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                texts = part.column(5).to_pylist()
                held.append([part.column(k).to_numpy(zero_copy_only=False) for k in range(5)] + [texts])
                used += sum(map(len, texts))
                if used >= letters:
                    rows = joined(held)
                    change = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1]))
                    end = int(change[-1]) + 1 if len(change) else 0     # the last group may go on
                    if end:
                        yield from answer(cut(rows, 0, end))
                    held = [cut(rows, end, len(rows[5]))]
                    used = sum(map(len, held[0][5]))
        if held and sum(len(p[5]) for p in held):
            yield from answer(joined(held))
        C.let_go()

    return dealt.mapInArrow(run, schema)


def _kinds(found: DataFrame, *one: str) -> DataFrame:
    """(fp, ctx, places, all, kinds, one columns): the distinct contexts of the
    anchors that occur more than once, written.  ``found`` (fp, ctx, places, ...)."""
    distinct = C.written(found.groupBy("fp", "ctx").agg(F.sum("places").alias("places"), F.min(F.struct(*one)).alias("one")), "suffix-distinct")
    shared = distinct.groupBy("fp").agg(F.sum("places").alias("all"), F.count(F.lit(1)).alias("kinds")).filter(F.col("all") > 1)
    # written tables on both sides: a hot anchor's partition of the join can be split
    shared = C.written(shared, "suffix-counts")
    return C.written(distinct.join(shared, "fp").select("fp", "ctx", "places", "all", "kinds", "one.*"), "suffix-kinds")


def _pack(docs: DataFrame, text: str = "text") -> DataFrame:
    """``text`` as a compressed binary column ``z``: what the shuffles carry."""
    keep = [c for c in docs.columns if c != text]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("z", T.BinaryType())])

    def run(batches):
        import zstandard
        press = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            z = [press(t) for _, texts in C.chunks(column) for t in _utf8(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in keep] + [pa.array(z, pa.binary())],
                                             names=schema.names)
        C.let_go()

    return docs.select(*keep, text).mapInArrow(run, schema)


def _unpack(column) -> list[bytes]:
    import zstandard
    return list(map(zstandard.ZstdDecompressor().decompress, column.to_pylist()))


def repeated_windows(docs: DataFrame, length: int = 400, block_contexts: int = 16, letters: int = 1 << 17) -> DataFrame:
    """``docs`` (id, th, text).  Returns (id, th, spans): for each row with a
    repeated window the array of (first, last) window starts."""
    found = C.written(_find(docs, length), "suffix-contexts")
    # most anchors occur once: only the others go on
    often = found.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("fp")
    found = C.written(found.join(C.written(often, "suffix-often"), "fp", "left_semi"), "suffix-shared")
    kinds = _kinds(found.withColumn("places", F.lit(1)), "id", "th", "at", "n")
    whole = kinds.filter("kinds = 1").select("fp", "ctx", F.lit(0).alias("first"), (F.col("n") - length).alias("last"))

    # the bytes of one context of each kind
    several = kinds.filter("kinds > 1")
    lists = several.groupBy("id", "th").agg(F.collect_list(F.struct("fp", "ctx", "places", "kinds", "at", "n")).alias("cut"))
    packed = _pack(C.likely_among(docs, [F.col("id"), F.col("th")], several.select("id", "th").distinct())[0])
    fetch = packed.join(lists, packed["id"].eqNullSafe(lists["id"]) & (packed["th"] == lists["th"])).select("z", "cut")

    def slices(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, DOCS):
                part = batch.slice(i, DOCS)
                cuts, data = part.column(1), _unpack(part.column(0))
                each = cuts.flatten()
                rows = np.repeat(np.arange(len(data)), [len(c) for c in cuts])
                at, n = (each.field(k).to_numpy() for k in ("at", "n"))
                own = pa.array([data[r][a:a + m] for r, a, m in zip(rows.tolist(), at.tolist(), n.tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays([each.field(k) for k in ("fp", "ctx", "places", "kinds")] + [own],
                                                 names=["fp", "ctx", "places", "kinds", "bytes"])
        C.let_go()

    ready = C.written(fetch.mapInArrow(slices, "fp long, ctx long, places long, kinds long, bytes binary"), "suffix-bytes")
    few = _shards(ready.filter(F.col("kinds") <= block_contexts).select(
        "fp", F.lit(0).alias("block"), F.lit(1).alias("blocks"), "ctx", "places", "bytes"), length, letters)
    few = few.select("fp", "ctx", "first", "last")

    # anchors with many kinds
    def cut(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, DOCS):
                part = batch.slice(i, DOCS)
                texts = part.column(3).to_pylist()
                _, _, _, _, _, anchor = contexts(texts, length)
                rows, new, ctx, at, own = [], [], [], [], []
                for r, (t, q) in enumerate(zip(texts, anchor.tolist())):
                    for g, d, a, m in refined(t, q, length):
                        rows.append(r), new.append(g), ctx.append(d), at.append(a), own.append(t[a:a + m])
                rows = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(rows), part.column(1).take(rows), pa.array(at, pa.int32()),
                    pa.array(np.array(new, np.uint64).view(np.int64)), pa.array(np.array(ctx, np.uint64).view(np.int64)),
                    part.column(2).take(rows), pa.array(own, pa.binary())], names=["pfp", "pctx", "base", "fp", "ctx", "places", "bytes"])
        C.let_go()

    hot = C.written(ready.filter(F.col("kinds") > block_contexts).select("fp", "ctx", "places", "bytes").mapInArrow(
        cut, "pfp long, pctx long, base int, fp long, ctx long, places long, bytes binary"), "suffix-refined")
    parts = _kinds(hot.withColumn("n", F.length("bytes")), "pfp", "pctx", "base", "n")
    blocks = F.ceil(F.col("kinds") / block_contexts).cast("int")
    chosen = parts.filter("kinds > 1").select("fp", "ctx", "pfp", "pctx", F.col("places").alias("m"), blocks.alias("blocks"),
                                             F.pmod(F.xxhash64("ctx"), blocks).cast("int").alias("block"))
    solved = C.written(_shards(hot.join(chosen, ["fp", "ctx", "pfp", "pctx"]).select(
        "fp", "block", "blocks", "ctx", F.col("m").alias("places"), "bytes"), length, letters), "suffix-solved")
    # runs of groups with several blocks, added up across blocks
    apart = solved.filter("h1 is not null")
    repeats = apart.groupBy("fp", "h1", "h2").agg(F.sum("places").alias("all")).filter("all > 1").select("fp", "h1", "h2")
    many = apart.join(repeats, ["fp", "h1", "h2"]).select("fp", "ctx", "first", "last") \
        .union(solved.filter("h1 is null").select("fp", "ctx", "first", "last")) \
        .union(parts.filter("kinds = 1").select("fp", "ctx", F.lit(0).alias("first"), (F.col("n") - length).alias("last")))
    many = hot.select("pfp", "pctx", "base", "fp", "ctx").join(many, ["fp", "ctx"]).select(
        F.col("pfp").alias("fp"), F.col("pctx").alias("ctx"), (F.col("base") + F.col("first")).alias("first"),
        (F.col("base") + F.col("last")).alias("last"))

    spans = whole.union(few).union(many)
    back = found.select("id", "th", "fp", "ctx", "at").join(spans, ["fp", "ctx"])
    return back.groupBy("id", "th").agg(F.collect_set(F.struct((F.col("at") + F.col("first")).alias("first"),
                                                              (F.col("at") + F.col("last")).alias("last"))).alias("spans"))


def _merge(data: bytes, firsts: np.ndarray, lasts: np.ndarray, length: int):
    """Kept bytes, bytes removed and number of removed runs."""
    if not len(firsts):
        return data, 0, 0
    change = np.zeros(len(data) + 1, np.int64)
    np.add.at(change, firsts, 1)
    np.add.at(change, lasts + length, -1)
    gone = np.cumsum(change[:-1]) > 0
    runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def dedup(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All rows and columns of ``docs``, the text as it is left (a span may cut
    a character: what is left of it goes), plus __n_bytes, __n_removed,
    __n_spans and __kept_sha256, the digest of the bytes that are left."""
    C.ship_package(docs.sparkSession)
    rows = docs.withColumn(text_col, F.coalesce(F.col(text_col), F.lit(""))) \
        .withColumn("__id", F.col(id_col).cast("long")).withColumn("__th", F.xxhash64(text_col))
    spans = repeated_windows(rows.select(F.col("__id").alias("id"), F.col("__th").alias("th"), F.col(text_col).alias("text")),
                             length, **options)
    spans = C.written(spans.select(F.col("id").alias("__sid"), F.col("th").alias("__sth"), F.col("spans").alias("__spans")), "suffix-spans")
    keep = [c for c in docs.columns if c != text_col]
    # texts that surely stay whole do not move
    some, whole = C.likely_among(rows, [F.col("__id"), F.col("__th")], spans.select("__sid", "__sth"))
    whole = whole.select(*keep, text_col, F.lit(None).cast(spans.schema["__spans"].dataType).alias("__spans"))
    some = _pack(some, text_col)
    some = some.join(spans, some["__id"].eqNullSafe(spans["__sid"]) & (some["__th"] == spans["__sth"]), "left").select(*keep, "z", "__spans")
    added = T.StructType([T.StructField(n, T.LongType()) for n in ("__n_bytes", "__n_removed", "__n_spans")]
                         + [T.StructField("__kept_sha256", T.StringType())])
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(text_col, T.StringType())] + list(added.fields))

    def run(batches, texts_of):
        for batch in batches:
            for i in range(0, batch.num_rows, DOCS):
                part = batch.slice(i, DOCS)
                texts, columns = texts_of(part.column(len(keep))), [[] for _ in range(5)]
                for data, own in zip(texts, part.column(len(keep) + 1)):
                    at = own.values
                    f, l = (at.field(k).to_numpy().astype(np.int64) for k in ("first", "last")) if at is not None else (np.zeros(0, int),) * 2
                    left, gone, count = _merge(data, f, l, length)
                    for column, value in zip(columns, (left.decode("utf-8", "ignore"), len(data), gone, count, hashlib.sha256(left).hexdigest())):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([part.column(k) for k in range(len(keep))] + [
                    pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                    names=schema.names)
        C.let_go()

    return whole.mapInArrow(lambda batches: run(batches, lambda column: _utf8(column.to_pylist())), schema) \
        .union(some.mapInArrow(lambda batches: run(batches, _unpack), schema))


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs).select("doc_id", F.col("__n_bytes").alias("n_bytes"), F.col("__n_removed").alias("n_removed"),
                              F.col("__n_spans").alias("n_spans"), F.col("__kept_sha256").alias("kept_sha256"))


def without_repeats(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without their repeated passages, strings of
    ``PASSAGE_BYTES`` bytes that start anywhere else too.  A text that keeps
    nothing stays as an empty text; ``n_chars`` is the new text's length."""
    out = dedup(docs, PASSAGE_BYTES)
    chars = F.when(F.col("__n_removed") == 0, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.withColumn("n_chars", chars).select(*docs.columns)
