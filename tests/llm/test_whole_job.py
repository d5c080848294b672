"""The whole input counts: nothing is left out of what an operator learns, keeps or searches."""

import numpy as np

from hearth.llm import ann, attention_lm
from tests.llm.data import documents, folder

LINE = ("the river went down from a high hill and under one old stone bridge before it came out by some green field where we had "
        "been for all of that long summer day with our two friends who then took us home again when night fell over everything").split()


def chunks_of(spark, texts):
    return attention_lm.chunked(documents(spark, texts).selectExpr("doc_id AS id", "text"))


def fitted(spark, texts, **more):
    import public_tokenizers as P
    path = P.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        sub = attention_lm.Subwords(f.read(), P.PATTERN)
    chunks = chunks_of(spark, texts)
    return attention_lm.fit(chunks, attention_lm.id_cells(chunks, path, P.PATTERN), path, P.PATTERN, **more), sub


# -- language model ------------------------------------------------------

def test_lm_learns_the_middles_and_ends_of_short_texts(spark):
    model, sub = fitted(spark, [(i, " ".join(LINE)) for i in range(300)])
    ids, size = sub.ids([w.encode() for w in LINE])
    assert len(ids) > attention_lm.WINDOW and len(LINE) < 384
    stream = np.append(ids, sub.size)
    own, _ = model.score_stream(stream, np.array([len(stream)]))
    # always the same text: every class and the end are foreseen, wherever they stand
    assert own[-1] > np.log(0.5) and (own > np.log(0.2)).all()


def test_lm_beats_its_base_on_held_out_texts(spark, tmp_path):
    import random
    rng = random.Random(6)
    texts = []
    for i in range(700):
        at = rng.randrange(len(LINE))
        texts.append((i, " ".join((LINE * 3)[at:at + rng.randint(40, 90)])))
    got = attention_lm.op5_attention_lm(spark, folder(spark, tmp_path, documents=documents(spark, texts))).collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 50 and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_windows_hold_every_id_once():
    texts = [[1, 2], [], list(range(10, 50)), list(range(32)), list(range(31))]
    stream = np.array([x for t in texts for x in [*t, 99]], np.uint16)
    m = attention_lm.text_windows(stream, 99)
    assert m[:, 1:][m[:, 1:] >= 0].tolist() == stream.tolist()
    assert (m[:, 0] == -2).sum() == len(texts)                               # one start each
    assert m[3, 0] == 41 and m[3, 1] == 42                                   # goes on where the window before ended
    assert attention_lm.text_windows(np.zeros(0, np.uint16), 99).shape == (0, attention_lm.WINDOW + 1)


def test_lm_passes_do_not_depend_on_the_size(spark, monkeypatch):
    rounds, init = [], attention_lm.Network.__init__
    monkeypatch.setattr(attention_lm.Network, "__init__", lambda self, w: (rounds.append(1), init(self, w))[1])
    for n in (3, 300):
        rounds.clear()
        fitted(spark, [(i, " ".join(LINE)) for i in range(n)], passes=3)
        assert len(rounds) == 1 + 3                                          # the driver makes one at first and one a round


def test_lm_keeps_every_pair_inside_words(spark):
    import public_tokenizers as P
    import random
    from collections import Counter
    rng = random.Random(4)
    texts = [(i, " ".join("".join(rng.choices("qzxjkvw", k=9)) for _ in range(40))) for i in range(60)]
    chunks = chunks_of(spark, texts)
    path = P.path("byte_bpe_multi_50k.tiktoken")
    cells = attention_lm.id_cells(chunks, path, P.PATTERN)
    model, sub = fitted(spark, texts)
    held = {r["id"]: r["held"] for r in chunks.collect()}
    pairs, heads, asked = Counter(), Counter(), set()
    for i, t in texts:
        for w in t.split():
            ids = sub.ids([w.encode()])[0].tolist()
            for a, b in zip(ids, ids[1:]):
                asked.add(a * sub.size + b)
                if not held[i]:
                    pairs[a * sub.size + b] += 1
                    heads[a * 2 * attention_lm.CLASSES + int(model.of[b])] += 1
    assert min(pairs.values()) == 1 and any(held.values())                   # rare ones are kept too
    got = attention_lm.pair_totals(cells, model).collect()
    assert {r["h"]: r["total"] for r in got if r["kind"] == 1} == dict(pairs)
    assert {r["h"]: r["total"] for r in got if r["kind"] == 2} == dict(heads)
    known = {k: tuple(np.array(x, np.int64) for x in zip(*sorted((r["h"], r["total"]) for r in got if r["kind"] == k))) for k in (1, 2)}
    some = next(p for p, n in pairs.items() if n == 1)
    a, b = divmod(some, sub.size)
    share = (1 + attention_lm.PRIOR * model.share[b]) / (heads[a * 2 * attention_lm.CLASSES + int(model.of[b])] + attention_lm.PRIOR)
    got = model.within(np.array([a, b]), np.array([0]), known[1], known[2])
    assert np.allclose(got, np.log10(model.share[a]) + np.log10(share))


# -- neighbours ----------------------------------------------------------

def vectors(spark, x):
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, embedding array<double>")


def test_neighbours_fill_k_rows_from_small_leaves(spark):
    x = np.random.default_rng(3).standard_normal((600, 6))
    # leaves of at most 8 vectors, and so little recall asked that calibration is content with one
    got = ann.search(vectors(spark, x), "id % 20 = 0", leaf_rows=8, recall=0.001).groupBy("query_id").count().collect()
    assert {r["query_id"]: r["count"] for r in got} == {i: 20 for i in range(0, 600, 20)}


def test_neighbours_are_calibrated_on_rows_outside_the_sample(spark, monkeypatch):
    x = np.random.default_rng(5).standard_normal((900, 6))
    fitted_on, asked = [], []
    build, calibrate = ann.build_tree, ann.calibrate
    monkeypatch.setattr(ann, "build_tree", lambda sample, *a: (fitted_on.append(sample), build(sample, *a))[1])
    monkeypatch.setattr(ann, "calibrate", lambda f, t, queries, *a: (asked.append(queries), calibrate(f, t, queries, *a))[1])
    ann.search(vectors(spark, x), "id % 20 = 0", sample_rows=300, leaf_rows=16)
    known = set(map(tuple, fitted_on[0]))
    assert len(known) == 300 and len(asked[0]) and not known & set(map(tuple, asked[0]))


def test_calibration_counts_the_best_hit_of_a_short_vector(spark):
    # inner products: the long vector, not the query itself, comes first
    x = np.array([[1.0, 0.0], [9.0, 0.0], [0.0, 1.0], [0.1, 1.0]])
    tree = ann.build_tree(x, 81.0, 1)
    v = ann.usable(vectors(spark, x)).toPandas().sort_values("id")
    v["leaf"] = tree.assign(np.stack(v["v"].to_numpy()))
    filed = spark.createDataFrame(v[["h1", "h2", "v", "leaf"]].assign(v=v["v"].map(list)), "h1 long, h2 long, v array<double>, leaf long")
    order = tree.visits(x[0], tree.leaves)
    assert ann.calibrate(filed, tree, x[:1], v[["h1", "h2"]].to_numpy()[:1], 1, 1.0) == order.index(int(v["leaf"].iloc[1])) + 1
