import hashlib
import io
import random
import re
from contextlib import redirect_stdout

import numpy as np
import xxhash
from pyspark.sql import functions as F

from hearth.llm import _common as C
from hearth.llm import simhash, spotsigs, suffix_dedup
from hearth.llm._graph import connected_components
from tests.llm.data import awkward, documents, folder


def fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(codes, bits):
    """Least index reachable, by index."""
    root = list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(codes))]


def test_simhash_query(spark, tmp_path):
    texts = [x for x in awkward(n=80) if x[0] is not None]
    got = simhash.op4_simhash(spark, folder(spark, tmp_path, documents=documents(spark, texts))).collect()
    codes = [fingerprint(t) for _, t in texts]
    root = groups(codes, 4)
    least = {}
    for (i, _), r in zip(texts, root):
        least[r] = min(i, least.get(r, i))
    want = sorted((i, f"{c:016x}", least[r]) for (i, _), c, r in zip(texts, codes, root))
    assert sorted(map(tuple, got)) == want


def test_links_of_close_codes(spark):
    """Chains and balls of near codes, with buckets cut into parts."""
    rng = random.Random(4)
    codes = set()
    for _ in range(12):
        c = rng.getrandbits(64)
        for _ in range(25):
            codes.add(c)
            c ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "fp long")
    root = groups(codes, 4)
    want = {}
    for s, r in zip(signed, root):
        want.setdefault(r, set()).add(s)
    want = sorted(sorted(g) for g in want.values() if len(g) > 1)
    for rows in (20_000, 10):
        out = connected_components(simhash.links(df, 4, bucket_rows=rows, task_rows=50)).collect()
        have = {}
        for r in out:
            have.setdefault(r["root"], set()).add(r["node"])
        assert sorted(sorted(g) for g in have.values()) == want


def kept_rows(texts):
    """By brute force: of each component the first row by id (null last); which of several texts of an id stays is free."""
    codes = [fingerprint(t) for _, t in texts]
    root = groups(codes, 4)
    out = {}
    for (i, t), r in zip(texts, root):
        out.setdefault(r, []).append((i is None, i, t or ""))
    return [[x[2] for x in rows if x[:2] == min(y[:2] for y in rows)] for rows in out.values()], \
        [min(rows, key=lambda y: (y[0], y[1] or 0))[1] for rows in out.values()]


def test_one_of_each_group(spark):
    extra = "an unrelated text under an id that some other row has as well, of quite other words"
    texts = awkward(n=60) + [(1006, extra), (None, extra + " again"), (None, extra + " again"), (5, "a text of its own beside number five"),
                             (None, None), (3, None)]
    docs = documents(spark, texts)
    kept = simhash.one_of_each_group(spark, docs, "")
    assert kept.columns == docs.columns
    got = [(r["doc_id"], r["text"] or "") for r in kept.select("doc_id", "text").collect()]
    allowed, ids = kept_rows(texts)
    assert sorted(map(str, ids)) == sorted(str(i) for i, _ in got)                  # one row a component
    left = list(got)
    for texts_of, i in zip(allowed, ids):
        left.remove(next(x for x in left if x[0] == i and x[1] in texts_of))
    assert not left and (1006, extra) in got and (None, extra + " again") in got
    assert simhash.one_of_each_group(spark, documents(spark, []), "").count() == 0


def test_spotsigs_query(spark, tmp_path):
    texts = [x for x in awkward(n=30) if x[0] not in (None, 1006)] + [(1006, "the same twice"), (1009, "the same twice")]
    got = {r["doc_id"]: r for r in spotsigs.op1_spotsigs(spark, folder(spark, tmp_path, documents=documents(spark, texts))).collect()}
    rows = sorted((i, t or "") for i, t in texts)
    cut = lambda s: {s[k:k + 8] for k in range(0, len(s), 8)}            # noqa: E731
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[1][:half]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = cut(r["fingerprint"]), cut(r["edited_fingerprint"]), cut(got[after[0]]["fingerprint"])
        assert np.isclose(r["near_edited"], len(a & b) / len(a | b)) and np.isclose(r["near_next"], len(a & c) / len(a | c))
    assert got[1006]["fingerprint"] == got[1009]["fingerprint"]


def test_successors_across_ranges(spark):
    rows = [(i * i % 997, f"t{i * i % 997}") for i in range(400)]
    df = spark.createDataFrame(rows, "id long, text string").distinct()
    got = {r["id"]: r["next"] for r in spotsigs.with_next(df, range_rows=7).collect()}
    ids = sorted({i for i, _ in rows})
    assert got == {i: f"t{ids[(k + 1) % len(ids)]}" for k, i in enumerate(ids)}


def test_spotsigs_empty_and_single(spark, tmp_path):
    assert spotsigs.op1_spotsigs(spark, folder(spark, tmp_path, documents=documents(spark, []))).count() == 0
    r = spotsigs.op1_spotsigs(spark, folder(spark, tmp_path, documents=documents(spark, [(3, "only the one text")]))).collect()
    assert len(r) == 1 and r[0]["near_next"] == 1.0


def test_likely_among_misses_no_key(spark):
    df = spark.range(0, 20_000).select(F.when(F.col("id") % 9 > 0, F.col("id")).alias("a"), (F.col("id") * 7).alias("b"))
    keys = df.where("b % 10 = 0")
    for most in (1 << 24, 1 << 12):
        some, rest = C.likely_among(df, [F.col("a"), F.col("b")], keys, most_bits=most)
        assert some.columns == df.columns and some.where("b % 10 = 0").count() == 2_000 and some.count() + rest.count() == 20_000
        assert most < 1 << 24 or some.count() < 4_000
    some, rest = C.likely_among(df, [F.col("a"), F.col("b")], keys.limit(0))
    assert (some.count(), rest.count()) == (0, 20_000)


def test_dedup_stages_do_not_move_texts_that_stay(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(8))     # noqa: E731
    texts = [(i, " ".join(word() for _ in range(150))) for i in range(400)]
    texts += [(1000 + i, t) for i, t in texts[:20]]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = documents(spark, texts)
        for stage in (simhash.one_of_each_group, suffix_dedup.without_repeats):
            out = stage(spark, docs, "")
            assert out.count() == (400 if stage is simhash.one_of_each_group else 420)
            buf = io.StringIO()
            with redirect_stdout(buf):
                out.explain("formatted")
            # the rows that are joined pass the filter first
            assert "getbit(" in buf.getvalue() and "Union" in buf.getvalue()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
