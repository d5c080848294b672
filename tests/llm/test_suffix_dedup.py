import hashlib
import random

import numpy as np
import pytest

from hearth.llm.suffix_dedup import dedup
from hearth.llm.suffix_sort import permuted_prefixes, suffix_arrays
from tests.llm.data import awkward, documents


def brute(texts, length):
    """(bytes, removed, runs, digest) by row: a byte goes if a repeated string covers it."""
    data = [(t or "").encode() for _, t in texts]
    seen = {}
    for r, b in enumerate(data):
        for i in range(len(b) - length + 1):
            seen.setdefault(b[i:i + length], []).append((r, i))
    gone = [np.zeros(len(b), bool) for b in data]
    for places in seen.values():
        if len(places) > 1:
            for r, i in places:
                gone[r][i:i + length] = True
    out = []
    for (i, _), b, g in zip(texts, data, gone):
        kept = bytes(np.frombuffer(b, np.uint8)[~g])
        runs = int((np.diff(np.append(0, g.astype(int))) == 1).sum())
        out.append((i, len(b), int(g.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def answer(df):
    return sorted(((r["doc_id"], r["__n_bytes"], r["__n_removed"], r["__n_spans"], r["__kept_sha256"]) for r in df.collect()), key=str)


def shared_passages(n=40, seed=1):
    rng = random.Random(seed)
    letters = "abcdefgh "
    text = lambda k: "".join(rng.choice(letters) for _ in range(k))     # noqa: E731
    passages = [text(450), text(900), text(401), text(390), "xyz" * 200]
    out = []
    for i in range(n):
        out.append((i, text(rng.randint(0, 500)) + rng.choice(passages) + text(rng.randint(0, 500)) + rng.choice(passages)))
    return out


@pytest.mark.parametrize("block", [2, 16])
def test_matches_brute_force(spark, block):
    texts = shared_passages() + awkward()
    assert answer(dedup(documents(spark, texts), block_contexts=block)) == brute(texts, 400)


def test_all_rows_alike_and_empty_table(spark):
    texts = [(i, "abc def " * 60) for i in range(30)]
    assert answer(dedup(documents(spark, texts))) == brute(texts, 400)
    assert dedup(documents(spark, [])).count() == 0


def test_suffix_arrays_and_prefixes():
    rng = random.Random(2)
    for _ in range(60):
        strings = [[rng.randint(1, rng.choice([1, 2, 9])) for _ in range(rng.randint(0, 40))] * rng.choice([1, 3]) for _ in range(rng.randint(1, 9))]
        strings.sort(key=len, reverse=True)
        lengths = np.array([len(x) + 1 for x in strings])
        begin = np.cumsum(lengths) - lengths
        s = np.concatenate([np.array([*x, 0]) for x in strings]).astype(np.int64)
        sa = suffix_arrays(s, begin, lengths, np.full(len(begin), 12))
        plcp = permuted_prefixes(s, sa, begin)
        for x, b, n in zip(strings, begin, lengths):
            y = [*x, 0]
            order = sorted(range(n), key=lambda i: y[i:])
            assert (sa[b:b + n] - b).tolist() == order
            for u, v in zip(order, order[1:]):
                same = 0
                while y[u + same:u + same + 1] == y[v + same:v + same + 1] and same < n:
                    same += 1
                assert plcp[b + v] == same
