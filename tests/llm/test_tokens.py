import base64
import hashlib
import os
import random
import zlib

import numpy as np
import public_tokenizers as P
import tiktoken
from tokenizers import Tokenizer

from hearth.llm import bpe, packing
from hearth.llm._units import Pieces, stretches
from tests.llm.data import awkward, documents, folder


def hard_texts(seed=5, n=300):
    rng = random.Random(seed)
    letters = "abc dee  \n\t thehe!?é漢字😀  \x1c\x85\xa0 aaa0019'sß"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(n)]
    return texts + ["a" * 3000, "ab" * 2000, "漢" * 900, "", " ", "  a", "a  ", " " * 700, "<|endoftext|> x",
                    "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(6000))]


def test_matrices_encode_as_the_library():
    raw = open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read()
    v = bpe.Vocabulary(raw, P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=v.rank, special_tokens={})
    texts, pieces = hard_texts(), Pieces(v.encode)
    for t, ids in zip(texts, pieces.texts(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t)
        assert v.decode(ids) == t.encode()


def tokenizer():
    return packing._tokenizer(open(P.path("byte_bpe_50k.tiktoken"), "rb").read(), P.PATTERN, packing.added_tokens(P.path("byte_bpe_50k.json")))


def test_packing_ids_are_those_of_the_tokenizer_file():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces = tokenizer()
    texts = hard_texts() + ["<|endoftext|>", "a<|endoftext|><|endoftext|> b  <|endoftext|>\n", "<|endoftext| >", "x" * 500 + " <|endoftext|>é"]
    assert [np.frombuffer(x, "<u4").tolist() for x in pieces.texts(texts)] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_packing_encodes_whole_texts_and_cuts_long_ones_where_ids_stay_the_same(monkeypatch):
    t, asked = tokenizer(), []
    encode = t.encode
    monkeypatch.setattr(t, "encode", lambda x: asked.append(len(x)) or encode(x))
    texts = [" ".join(f"w{i}" for i in range(5000)), "a b<|endoftext|> c"]
    assert t.texts(texts)[0] == np.array(encode(texts[0]), "<u4").tobytes()
    assert asked == [len(texts[0]), 3, 2]                    # a call for each text or stretch between added tokens, not for each word
    long = "ab  \n c \u00a0 d\u3000 e\tf g   " * 700 + "x" * 9000 + " \n" * 50 + " z"
    for size in (1, 2, 7, 100, 5000):
        parts = list(stretches(long, size))
        assert "".join(parts) == long and (len(parts) > 1 and all(len(p) < size + 9200 for p in parts))
        assert [i for p in parts for i in encode(p)] == encode(long)
    assert list(stretches("")) == [""]


def test_bpe_query(spark, tmp_path):
    texts = awkward()
    got = bpe.op3_bpe(spark, folder(spark, tmp_path, documents=documents(spark, texts))).collect()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in texts:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_packing_query(spark, tmp_path):
    texts = awkward() + [(4000, "one <|endoftext|> two")]
    got = packing.op8_packing(spark, folder(spark, tmp_path, documents=documents(spark, texts))).collect()
    pieces = tokenizer()
    # every sequence but the last is full and without gaps
    rows = {}
    for r in got:
        rows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    last = max(rows)
    assert sorted(rows) == list(range(last + 1))
    for s, own in rows.items():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at == 1024 if s != last else at <= 1024
    # each row's pieces are its ids: compared by id, starts and checksums
    want = {}
    for (i, t), ids in zip(texts, pieces.texts([t or "" for _, t in texts])):
        want.setdefault(i, []).append(ids + bytes(4))
    seen = {}
    for r in got:
        seen.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    for i, lists in want.items():
        for ids in set(lists):
            own = seen[i, len(ids) // 4]
            for r in own:
                part = ids[4 * r["start"]:4 * (r["start"] + r["length"])]
                if sum(len(x) == len(ids) for x in lists) == lists.count(ids):
                    assert r["ids_crc32"] == zlib.crc32(part)
            assert sum(r["length"] for r in own) == sum(len(x) // 4 for x in lists if len(x) == len(ids))


def test_empty_table(spark, tmp_path):
    sf = folder(spark, tmp_path, documents=documents(spark, []))
    assert bpe.op3_bpe(spark, sf).count() == 0
    assert packing.op8_packing(spark, sf).count() == 0
