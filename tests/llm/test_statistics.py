"""Reversed search, quality classifier and divergence audit against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from hearth.llm import divergence as D
from hearth.llm import quality as Q
from hearth.llm import queries
from hearth.llm import reversed_search as R

from .data import awkward, documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_search(docs, items, k):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    of = lambda t: term.findall((t or "").translate(LOWER))
    found = [(i, of(t)) for i, t in docs]
    n_docs, total = sum(bool(t) for _, t in found), sum(len(t) for _, t in found)
    df = Counter(w for _, t in found for w in set(t))
    texts = defaultdict(set)
    for i, t in items:
        texts[i].add(t or "")
    out = set()
    for item, own in texts.items():
        wanted, scored = Counter(w for t in own for w in of(t)), []
        for i, t in found:
            tf, score = Counter(t), 0
            for w, q in wanted.items():
                if tf[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    m = 100 - 25 + (25 * len(t) * n_docs) // total
                    score += q * weight * ((1000000000 * tf[w]) // (1000 * tf[w] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i if i is not None else 0))
        for r, (s, none, i) in enumerate(sorted(scored)[:k], 1):
            out.add((item, r, None if none else i, -s))
    return out


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 7, 0.5) for i, t in rows], "item_id long, text string, rank int, score double")


ITEMS = [(1, "The of the ER, in"), (2, ""), (3, None), (4, "漢 é THE"), (4, "漢 é THE"), (5, "nowhere"), (6, "the"), (6, "same twice"), (None, "of on")]


@pytest.mark.parametrize("block_terms,block_items", [(2_000_000, 20_000), (3, 2)])
def test_search_equals_brute_force(spark, block_terms, block_items):
    docs = awkward()
    got = R.search(documents(spark, docs), items_of(spark, ITEMS), k=7, block_terms=block_terms, block_items=block_items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in got.collect()} == brute_search(docs, ITEMS, 7)


def test_search_over_empty_tables(spark):
    none = documents(spark, [])
    assert R.search(none, items_of(spark, ITEMS)).count() == 0
    assert R.search(documents(spark, [(1, "the")]), items_of(spark, [])).count() == 0
    assert R.search(documents(spark, [(1, None), (2, "?")]), items_of(spark, ITEMS)).count() == 0


def test_search_in_small_pieces_and_ties(spark, monkeypatch):
    monkeypatch.setattr(R, "CELLS", 10)
    index = R.Index([1, 2], {b"a": [(0, 2), (1, 1)], b"b": [(1, 1)]})
    index.weigh(4, 9, {0: 3, 1: 1})
    heaps = R.Heaps(2, 2)
    rows = [index.counts(t) for t in ("a a b", "a", "a", "b c")]
    heaps.offer([5, 9, 3, None], index.scores(rows))
    score = index.scores(rows)
    assert {d for _, d in heaps.heaps[0]} == {-5, -3} and score[1, 0] == score[2, 0] > 0   # the tie goes to the smaller id
    assert heaps.least[0] == score[2, 0] and {d for s, d in heaps.heaps[1]} == {-5, R._NO_ID}


# ---------------------------------------------------------------- divergence

def brute_audit(docs, min_docs, top):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    found = [(lang or "", source or "", term.findall((t or "").translate(LOWER))) for lang, source, t in docs]
    df, counts, groups = Counter(), defaultdict(Counter), defaultdict(set)
    for lang, source, ts in found:
        groups[lang].add(source)
        df.update((lang, w) for w in set(ts))
        counts[lang, source].update(ts)
    out = set()
    for lang, sources in groups.items():
        kept = sorted((w for (g, w), n in df.items() if g == lang and n >= min_docs), key=str.encode)
        v = len(kept)

        def shares(c):
            n = sum(c[w] for w in kept)
            return {w: 1 + 10 ** 9 * (c[w] + 2) // (n + 2 * v) for w in kept}
        usual = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = sorted(((-sum(f(p[s][w], p[o][w]) for w in kept), o.encode(), o) for o in sources if o != s))
            out |= {(lang, s, "pair", o, -x, r) for r, (x, _, o) in enumerate(pairs, 1)}
            told = sorted((-f(p[s][w], usual[w]), w.encode(), w) for w in kept if counts[lang, s][w] > 0 and p[s][w] > usual[w])
            out |= {(lang, s, "term", w, -x, r) for r, (x, _, w) in enumerate(told[:top], 1)}
    return out


def sourced(seed=5, n=80):
    rng = random.Random(seed)
    vocabulary = ["Haus", "éa", "la", "THE", "x1y", "漢字", "of", "Ñu", "zz", "word", "w" * 300]
    docs = [(rng.choice(["en", "en", "en", "fr", None]), rng.choice(["a", "b", "é", "", None, "Z"]),
             " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30)))) for _ in range(n)]
    docs += [("en", "a", None), ("xx", "only", "la la"), ("yy", "p", "la"), ("yy", "q", None), ("en", "silent", "..."), ("en", "a", docs[0][2])]
    return docs


def table(spark, docs):
    rows = [(i, t, lang, source, 3, "x", 1, 1.5) for i, (lang, source, t) in enumerate(docs)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long, term string, slot long, p double")


def test_audit_equals_brute_force(spark):
    docs = sourced()
    got = D.audit(table(spark, docs), min_docs=4, top=3)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert {tuple(r) for r in got.collect()} == brute_audit(docs, 4, 3)
    assert D.audit(table(spark, []), min_docs=1).count() == 0


def test_audit_in_rounds_tiles_and_small_blocks(spark, monkeypatch):
    docs = sourced(8)
    monkeypatch.setattr(D, "SHARD_BYTES", 40)
    monkeypatch.setattr(D, "SLOTS", 2)
    monkeypatch.setattr(D, "TILE", 2)
    got = D.audit(table(spark, docs), min_docs=3, top=10, round_bytes=200)
    assert {tuple(r) for r in got.collect()} == brute_audit(docs, 3, 10)


def test_perfect_hash_takes_no_foreign_key(monkeypatch):
    keys = [f"key{i}é".encode() for i in range(5000)]
    h = D.PerfectHash.build(keys)
    slots = h.slots(keys, D._hashes(keys))
    assert sorted(slots) == list(range(5000)) and all(h.key(s) == k for s, k in zip(slots.tolist(), keys))
    other = [f"other{i}".encode() for i in range(5000)]
    assert (h.slots(other, D._hashes(other)) == -1).all()
    assert D.PerfectHash.build([]).n == 0
    # equal hashes: the stored keys decide
    same = [b"a", b"b", b"c"]
    monkeypatch.setattr(D, "_hashes", lambda ks: np.full(len(ks), 9, dtype=np.uint64))
    h = D.PerfectHash.build(same)
    assert sorted(h.slots(same, D._hashes(same))) == [0, 1, 2] and h.slots([b"d"], D._hashes([b"d"]))[0] == -1


def test_oracles_of_the_queries(spark, tmp_path):
    """The registered SQL and the queries give the same rows over an awkward table."""
    docs = [(i, t, lang, source, 0) for i, (lang, source, t) in enumerate(sourced(2, 120))]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, t) for i, t in ITEMS if i], "item_id long, text string").dropDuplicates().write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    for name in ("op11_reversed_search", "op13_divergence"):
        want = con.execute(queries.SQL[name]).fetchall()
        got = [tuple(r) for r in queries.QUERIES[name](spark, str(tmp_path)).collect()]
        assert Counter(got) == Counter(want) and got


# ---------------------------------------------------------------- quality

def good(rng):
    return " ".join(rng.choice(["house", "river", "walk", "green", "the", "of", "and", "Child"]) for _ in range(rng.randint(20, 60))) + "."


def bad(rng):
    word = lambda: rng.choice(["house", "river", "walk", "green"])
    return rng.choice([lambda: " ".join(w + "###" for w in good(rng).split()), lambda: good(rng).upper().replace(" ", "!! "),
                       lambda: " ".join(" ".join([w] * 9) for w in good(rng).split()[:9]), lambda: " | ".join(word() for _ in range(30))])()


def test_quality_on_held_out_rows(spark, tmp_path):
    rng = random.Random(4)
    docs = [(i, bad(rng) if i % 4 == 0 else good(rng)) for i in range(600)]
    odd = [(9001, None), (9002, ""), (9003, "x " * 200_000), (None, "house"), (9004, docs[1][1]), (9004, docs[1][1])]
    documents(spark, docs + odd).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(i % 4 != 0), 0) for i, _ in docs] + [(i, 5, 0) for i in range(3)] + [(None, 1, 1), (77777, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = Q.op12_quality(spark, str(tmp_path)).collect()
    assert len(got) == len(docs) + len(odd) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 600]
    assert held and sum(r["predicted"] == int(r["doc_id"] % 4 != 0) for r in held) / len(held) > 0.95
    assert len({r["score"] for r in got if r["doc_id"] == 9004 or r["doc_id"] == 1}) == 1
    assert len({r["score"] for r in got if r["doc_id"] in (9001, 9002)}) == 1
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]


def test_held_out_labels_do_not_matter(spark):
    rng = random.Random(6)
    docs = documents(spark, [(i, bad(rng) if i % 3 == 0 else good(rng)) for i in range(150)])
    a = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(150)], "doc_id long, quality int")
    b = a.withColumn("quality", Q.F.when(Q.held_out(), 1 - Q.F.col("quality")).otherwise(Q.F.col("quality")))
    one, two = (Q.fit(docs, x.filter(~Q.held_out()), rounds=20) for x in (a, b))
    assert all((x == y).all() for x, y in zip(one.layers, two.layers)) and one.temperature == two.temperature


def test_quality_without_usable_labels(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    for labels, share in ([], 0.5), ([(1, 1)], 1.0), ([(1, 0), (2, 0)], 0.0), ([(5, 1)], 0.5), ([(1, None), (2, 3)], 0.5):
        model = Q.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert [r["score"] for r in Q.score(docs, model, keep=["doc_id"]).collect()] == [share, share]
    assert Q.op12_quality.__name__ in queries.QUERIES


def test_word_vectors_are_sums_of_neighbours_over_all_documents(spark):
    texts = ["a b c a a", "c b", "", "b A zz b"]
    lex = Q.Lexicon(["a", "b", "c"])
    got = Q.word_vectors(documents(spark, list(enumerate(texts))).select("text"), lex)
    want = np.zeros((4, Q.DIM))
    for t in texts:
        ws = [lex.number.get(w, 0) for w in Q.words(t)]
        for i, w in enumerate(ws):
            for j in (i - 2, i - 1, i + 1, i + 2):
                if 0 <= j < len(ws) and w and ws[j]:
                    for place, sign in zip(lex.places[ws[j]], lex.signs[ws[j]]):
                        want[w, place] += sign
    norm = np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    assert np.allclose(got, want / norm, atol=1e-6)
    assert Q.words("Ha ha HA!! HA!! 12 _x ||||||") == ["ha", "ha", Q.UPPER, "ha", "!!", Q.UPPER, "ha", "!!", "0", "_", "x", "||||"]


def test_pooling_in_slices(monkeypatch):
    lex = Q.Lexicon(["a", "b", "c"])
    vectors = np.random.default_rng(1).normal(size=(4, Q.DIM)).astype(np.float32)
    texts = ["a b c zz a", "", "c", "b " * 3 + "a " + "b c " * 20]
    whole = lex.pooled(texts, vectors)
    contexts = lex.contexts(texts)
    monkeypatch.setattr(Q, "SLICE", 3)
    assert np.allclose(lex.pooled(texts, vectors), whole, atol=1e-6) and (lex.contexts(texts) == contexts).all()
    ids, lengths = lex.numbers(texts)
    assert np.allclose(whole[0, :Q.DIM], vectors[ids[:lengths[0]]].mean(axis=0), atol=1e-6) and (whole[1, :Q.DIM] == 0).all()
