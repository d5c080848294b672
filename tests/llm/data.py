"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, fp long, ids string, score double, chunk long"


def documents(spark, texts):
    """A documents table; ``texts``: (doc_id, text) pairs.  It has columns named like the operators' own."""
    rows = [(i, t, "en", "s", None if t is None else len(t), 7, 7, "x", 0.5, 1) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def awkward(seed=3, n=40):
    rng = random.Random(seed)
    syllables = "the of er ha on in re st ed é ü 漢 😀 ou".split(" ")
    out = [(1000, None), (1001, ""), (1002, " \n\t "), (None, "a text without an id"), (1003, "the of the of"),
           (1004, "x" * 5000), (1005, "ab " * 3000), (1006, "the same twice"), (1006, "the same twice"), (1007, "THE Same Twice"),
           (1008, "Released under the MIT License."), (-5, "negative id")]
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 120))]
        out.append((i, " ".join(words)))
    out += [(2000 + i, out[20][1]) for i in range(3)]                       # exact copies
    out += [(2100 + i, out[21][1] + " " + "more " * i) for i in range(3)]   # near copies
    rng.shuffle(out)
    return out


def folder(spark, tmp_path, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)
