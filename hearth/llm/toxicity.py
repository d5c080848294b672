"""Toxicity: a counterfactual-regularised word classifier.

A logistic model over the words of a text is fitted to labelled texts.  In the
labelled sentences that name a group (``IDENTITY_TERMS``) the name is swapped
for every other name of its kind and for no name at all, and the squared
change of the score's logit under a swap is a penalty beside the loss.  A
group's name therefore cannot raise a score by itself, so neutral mentions of
a group are not false positives.

Fitting uses a bounded sample of labelled rows (``max_rows``, chosen by hash of
the id); scoring covers every whole text.

Defined results: a null or empty text gets the model's bias score; repeated
rows are scored alike; labels other than 0 and 1, labels without a document
and null ids are not learned from; with no usable label every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm import _common as C

# Names of groups, by kind (English, French, German, Spanish).
IDENTITY_TERMS = {
    "gender": "woman women man men girl girls boy boys femme femmes homme hommes frau frauen mann mujer mujeres hombre",
    "faith": "christian christians muslim muslims jew jews jewish hindu hindus buddhist buddhists atheist atheists "
             "musulman chrétien juif moslem christ jude musulmán cristiano judío",
    "origin": "african african-american asian european american mexican chinese indian arab arabs black white latino "
              "immigrant immigrants refugee refugees",
    "orientation": "gay lesbian bisexual straight heterosexual homosexual transgender trans queer",
    "ability": "blind deaf disabled autistic old young elderly",
}

_KEEP = bytes(range(128, 256)) + b"abcdefghijklmnopqrstuvwxyz"
_TO_WORDS = bytes((c + 32 if 65 <= c <= 90 else c) if (c + 32 if 65 <= c <= 90 else c) in _KEEP else 32 for c in range(256))
_TO_SENTENCES = bytes(10 if c in b".!?\n\r" else _TO_WORDS[c] for c in range(256))


def words(text: str) -> list[bytes]:
    """Lower-case words: runs of letters (every character beyond ASCII counts as one)."""
    return text.lower().encode("utf-8", "replace").translate(_TO_WORDS).split()


def _identity() -> dict[bytes, str]:
    return {t.encode(): kind for kind, names in IDENTITY_TERMS.items() for t in names.split()}


@dataclass
class Model:
    """A word's weight applies to log(1 + its count in the text)."""

    weights: dict[bytes, float] = field(default_factory=dict)
    bias: float | None = None

    def score(self, text: str) -> float:
        if self.bias is None:
            return 0.0
        counts: dict[bytes, int] = {}
        weights = self.weights
        for w in words(text):
            if w in weights:
                counts[w] = counts.get(w, 0) + 1
        z = self.bias + sum(weights[w] * np.log1p(n) for w, n in sorted(counts.items()))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def training_labels(labels: DataFrame, max_rows: int, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """At most ``max_rows`` labelled ids, the least by hash."""
    usable = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")) \
        .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1))
    return usable.orderBy(F.xxhash64("id"), "id", "label").limit(max_rows)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, vocabulary: int = 1_024, min_docs: int = 5,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", counterfactual: float = 1.0,
        l2: float = 1e-4, rounds: int = 300) -> Model:
    """Fit on at most ``max_rows`` labelled texts.  What reaches the driver is
    bounded: ``vocabulary`` words and their counts in the sampled texts."""
    chosen = training_labels(labels, max_rows, id_col, label_col)
    text = C.id_and_text(docs, id_col, text_col).filter(F.col("id").isNotNull())
    # at most max_rows rows of two numbers
    sample = C.written(text.join(F.broadcast(chosen), "id").select("label", "text"), "toxicity-sample")

    identity = _identity()
    found = C.map_text(sample, lambda texts: [[sorted(set(words(t))) for t in texts]],
                       T.StructType([T.StructField("words", T.ArrayType(T.BinaryType()))]), keep=["label"])
    each = found.select("label", F.explode("words").alias("word")).groupBy("word") \
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos"))
    total = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos")).first()
    if not total["n"] or total["pos"] in (0, None):
        return Model()
    share = total["pos"] / total["n"]
    spread = F.sqrt(F.col("n") * F.lit(share * (1 - share) + 1e-9))
    telling = each.filter((F.col("n") >= min_docs)).withColumn("z", F.abs(F.col("pos") - F.col("n") * F.lit(share)) / spread) \
        .orderBy(F.col("z").desc(), "word").limit(vocabulary)
    vocab = sorted({bytes(r["word"]) for r in telling.select("word").collect()} | set(identity))
    place = {w: i for i, w in enumerate(vocab)}

    def features(texts):
        ids, logs, swaps = [], [], []
        for t in texts:
            counts: dict[int, int] = {}
            for w in words(t):
                i = place.get(w)
                if i is not None:
                    counts[i] = counts.get(i, 0) + 1
            ids.append(list(counts))
            logs.append([float(np.log1p(n)) for n in counts.values()])
            named = [place[w] for w in identity if place[w] in counts]
            # one entry for each labelled sentence and group name in it
            swaps.append([] if not named else [place[w] for s in t.lower().encode("utf-8", "replace").translate(_TO_SENTENCES).split(b"\n")
                                               for w in s.split() if w in identity])
        return [ids, logs, swaps]

    wanted = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("logs", T.ArrayType(T.DoubleType())),
                           T.StructField("swaps", T.ArrayType(T.IntegerType()))])
    rows = C.map_text(sample, features, wanted, keep=["label"]).toPandas()   # max_rows rows of known words
    return _fit_numpy(rows, vocab, identity, counterfactual, l2, rounds)


def _fit_numpy(rows, vocab, identity, counterfactual, l2, rounds) -> Model:
    y = rows["label"].to_numpy(dtype=float)
    sizes = rows["ids"].map(len).to_numpy()
    r = np.repeat(np.arange(len(rows)), sizes)
    c = np.concatenate([*rows["ids"], np.zeros(0)]).astype(int)
    v = np.concatenate([*rows["logs"], np.zeros(0)])
    # swapped pairs (name, other name or -1 for none) with how often they occur
    place = {w: i for i, w in enumerate(vocab)}
    kinds: dict[str, list[int]] = {}
    for w, kind in identity.items():
        kinds.setdefault(kind, []).append(place[w])
    of = {place[w]: kind for w, kind in identity.items()}
    seen: dict[int, int] = {}
    for s in rows["swaps"]:
        for i in s:
            seen[i] = seen.get(i, 0) + 1
    a, b, m = [], [], []
    for i, n in seen.items():
        others = [j for j in kinds[of[i]] if j != i] + [-1]
        a += [i] * len(others)
        b += others
        m += [n / len(others)] * len(others)
    a, b, m = np.array(a, int), np.array(b, int), np.array(m, float)
    m = counterfactual * m / max(m.sum(), 1e-9)

    k = len(vocab)
    w, bias = np.zeros(k), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    m1, m2 = np.zeros(k + 1), np.zeros(k + 1)
    one = np.log(2.0)
    for step in range(1, rounds + 1):
        z = bias + np.bincount(r, v * w[c], minlength=len(y))
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        g = np.bincount(c, v * (p - y)[r], minlength=k) / len(y) + l2 * w
        if len(a):
            change = one * (w[a] - np.where(b >= 0, w[b], 0.0))
            pull = 2 * m * one * change
            g += np.bincount(a, pull, minlength=k) - np.bincount(b[b >= 0], pull[b >= 0], minlength=k)
        full = np.append(g, np.mean(p - y))
        m1, m2 = 0.9 * m1 + 0.1 * full, 0.99 * m2 + 0.01 * full * full
        move = 0.1 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return Model({x: float(t) for x, t in zip(vocab, w)}, float(bias))


def score(docs: DataFrame, model: Model, score_col: str = "score", text_col: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """Append ``score_col`` (0 to 1) to every row, over its whole text."""
    return C.map_text(docs, lambda texts: [[model.score(t) for t in texts]],
                      T.StructType([T.StructField(score_col, T.DoubleType())]), text_col=text_col, keep=keep)


def held_out(id_col: str = "doc_id", folds: int = 5):
    """True for the fold whose labels are never learned (a null id is in no fold)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(False))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = C.read(spark, sf_dir, "documents"), C.read(spark, sf_dir, "labels")
    model = fit(docs, labels.filter(~held_out()))
    return score(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the classifier does not reject."""
    model = fit(docs, C.read(spark, sf_dir, "labels").filter(~held_out()))
    return score(docs, model, "__toxicity").filter("__toxicity < 0.5").select(*docs.columns)
