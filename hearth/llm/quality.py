"""Quality: random-indexing word vectors pooled per document, then a two-layer network with calibrated probabilities.

Words are runs of letters, of digits or of symbols.  A word equal to the one
before it is read as ``AGAIN`` and a word in capitals is also read as ``UPPER``,
so a text's form is part of its words.  Every word has a sparse random index
vector (``SPARSE`` entries of +1 or -1 drawn from its hash); a known word's
context vector is the sum of the index vectors of its neighbours up to
``WINDOW`` words away, over **all** documents, scaled to length one.  A document
is the mean of its words' context vectors with two shares beside it (words that
are not known, logarithm of the length), over its whole text.

The network (one hidden layer) is fitted in numpy on a bounded sample:
``max_rows`` labelled texts, chosen by hash of the id.  A fifth of them is kept
from the fit and sets the temperature its logits are divided by, so that scores
are probabilities.  ``vocabulary`` (the size of the model) bounds the known
words: those in most texts of the sample.

Defined results: a null or empty text is scored as a text without words;
repeated rows are scored alike; labels other than 0 and 1, labels without a
document and null ids are not learned from; with no usable labels, or labels of
one kind only, every score is that kind's share (0.5 without any).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm import _common as C
from hearth.llm.toxicity import training_labels

DIM, SPARSE, WINDOW, HIDDEN = 64, 4, 2, 32
AGAIN, UPPER = "\x00again", "\x00upper"
PIECE, SLICE = 1 << 18, 1 << 16   # characters of the texts, and words, that a task works on at once

_WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def words(text: str) -> list[str]:
    """The words of a text, with a mark for each repeated or capitalised one."""
    out, before = [], None
    for w in _WORD.findall(text):
        if w == before:
            out.append(AGAIN)
            continue
        before = w
        if len(w) > 1 and w.isupper():
            out.append(UPPER)
        out.append(w.lower() if w[0].isalpha() else "0" if w[0].isdigit() else w[:4])
    return out


def index_vector(word: str) -> tuple[list[int], list[int]]:
    """Places and signs of a word's random index vector."""
    h = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"), 7)
    return [(h >> (12 * i)) % DIM for i in range(SPARSE)], [1 - 2 * ((h >> (12 * i + 11)) & 1) for i in range(SPARSE)]


class Lexicon:
    """Known words by number; 0 stands for every other word."""

    def __init__(self, known: list[str]):
        self.number = {w: i + 1 for i, w in enumerate(known)}
        self.size = len(known) + 1
        vectors = [index_vector(w) for w in ["", *known]]
        self.places = np.array([p for p, _ in vectors], dtype=np.int64)
        self.signs = np.array([s for _, s in vectors], dtype=np.int64)
        self.signs[0] = 0   # an unknown word is no context

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words of all texts as numbers, and how many each text has."""
        found = [words(t) for t in texts]
        get = self.number.get
        return np.array([get(w, 0) for ws in found for w in ws], dtype=np.int64), np.array([len(ws) for ws in found], dtype=np.int64)

    def contexts(self, texts: list[str]) -> np.ndarray:
        """Sums of neighbours' index vectors by word (size x DIM) over some texts."""
        ids, lengths = self.numbers(texts)
        text = np.repeat(np.arange(len(texts)), lengths)
        out = np.zeros(self.size * DIM)
        for away in range(1, WINDOW + 1):
            near = (text[away:] == text[:-away]) & (ids[away:] > 0) & (ids[:-away] > 0)
            a, b = ids[:-away][near], ids[away:][near]
            for word, other in ((a, b), (b, a)):
                for s in range(0, len(word), SLICE):
                    w, o = word[s:s + SLICE], other[s:s + SLICE]
                    out += np.bincount((w[:, None] * DIM + self.places[o]).ravel(), self.signs[o].ravel(), minlength=len(out))
        return out.astype(np.int64).reshape(self.size, DIM)

    def pooled(self, texts: list[str], vectors: np.ndarray) -> np.ndarray:
        """One row a text: mean word vector, share of unknown words, log length."""
        out = np.zeros((len(texts), DIM + 2))
        ids, lengths = self.numbers(texts)
        some = np.flatnonzero(lengths)
        if len(some):
            starts = (np.cumsum(lengths) - lengths)[some]
            n = lengths[some].astype(float)
            for a in range(0, len(ids), SLICE):   # a long text is summed slice by slice
                first, last = np.searchsorted(starts, a, "right") - 1, np.searchsorted(starts, a + SLICE)
                at = np.maximum(starts[first:last] - a, 0)
                out[some[first:last], :DIM] += np.add.reduceat(vectors[ids[a:a + SLICE]], at, axis=0)
            out[some, :DIM] /= n[:, None]
            out[some, DIM] = np.add.reduceat((ids == 0).astype(float), starts) / n
        out[:, DIM + 1] = np.log1p(lengths) / 10
        return out


def _pieces(texts: list[str], most: int = PIECE):
    """Lists of texts of about ``most`` characters."""
    part, used = [], 0
    for t in texts:
        part.append(t)
        used += len(t)
        if used >= most:
            yield part
            part, used = [], 0
    if part:
        yield part


@dataclass
class Model:
    lexicon: Lexicon | None = None
    vectors: np.ndarray | None = None
    layers: list[np.ndarray] = field(default_factory=list)
    centre: np.ndarray | None = None
    spread: np.ndarray | None = None
    temperature: float = 1.0
    share: float = 0.5

    def features(self, texts: list[str]) -> np.ndarray:
        return np.concatenate([np.zeros((0, DIM + 2)), *[self.lexicon.pooled(p, self.vectors) for p in _pieces(texts)]])

    def scores(self, texts: list[str]) -> np.ndarray:
        if not self.layers:
            return np.full(len(texts), self.share)
        z = _logits(self.layers, (self.features(texts) - self.centre) / self.spread) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _logits(layers, x):
    w1, b1, w2, b2 = layers
    return np.tanh(x @ w1 + b1) @ w2 + b2[0]


def known_words(sample: DataFrame, vocabulary: int, min_texts: int = 3) -> list[str]:
    """The ``vocabulary`` words that stand in most texts of the sample."""
    found = C.map_text(sample, lambda texts: [[sorted(set(words(t))) for t in texts]],
                       T.StructType([T.StructField("words", T.ArrayType(T.StringType()))]), keep=[])
    most = found.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")) \
        .filter(F.col("n") >= min_texts).orderBy(F.col("n").desc(), "word").limit(vocabulary)
    return sorted(r["word"] for r in most.select("word").collect())


def word_vectors(docs: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """Context vectors of the known words over all documents, of length one.
    What reaches the driver is the model: ``vocabulary`` x DIM sums."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        lexicon = shared.value
        total = np.zeros((lexicon.size, DIM), dtype=np.int64)
        for batch in batches:
            for _, texts in C.chunks(batch.column(0), PIECE):
                total += lexicon.contexts(texts)
        at = np.flatnonzero(total.any(axis=1))
        values = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * DIM, pa.int32()), pa.array(total[at].ravel(), pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), values], names=["word", "sums"])

    each = docs.select("text").mapInArrow(run, "word long, sums array<long>")
    sums = each.groupBy("word").agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(DIM)]).alias("sums"))
    out = np.zeros((lexicon.size, DIM))
    for r in sums.collect():
        out[r["word"]] = r["sums"]
    out[0] = 0
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, vocabulary: int = 8_192, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", rounds: int = 400, l2: float = 1e-4) -> Model:
    """Word vectors over all of ``docs``; the network on at most ``max_rows`` labelled texts."""
    chosen = training_labels(labels, max_rows, id_col, label_col)
    text = C.id_and_text(docs, id_col, text_col)
    # at most max_rows rows of two numbers
    sample = C.written(text.filter(F.col("id").isNotNull()).join(F.broadcast(chosen), "id").select("id", "label", "text"), "quality-sample")
    share = sample.agg(F.avg("label")).first()[0]
    if share in (None, 0, 1):
        return Model(share=0.5 if share is None else float(share))
    lexicon = Lexicon(known_words(sample, vocabulary))
    model = Model(lexicon, word_vectors(text, lexicon), share=float(share))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = C.map_text(sample, lambda texts: [shared.value.features(texts).tolist()],
                      T.StructType([T.StructField("x", T.ArrayType(T.DoubleType()))]), keep=["id", "label"]).toPandas()
    rows = rows.sort_values(["id", "label"], kind="stable")   # max_rows rows of DIM + 2 numbers
    x, y = np.array(rows["x"].tolist()), rows["label"].to_numpy(dtype=float)
    kept = np.array([xxhash.xxh64_intdigest(str(i), 11) % 5 == 0 for i in rows["id"]])
    if kept.all() or not kept.any():
        kept = np.arange(len(y)) < 0
    _fit_network(model, x[~kept], y[~kept], x[kept], y[kept], rounds, l2)
    return model


def _fit_network(model: Model, x, y, x_kept, y_kept, rounds: int, l2: float) -> None:
    model.centre, model.spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    x, x_kept = (x - model.centre) / model.spread, (x_kept - model.centre) / model.spread
    rng = np.random.default_rng(5)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    layers = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.array([np.log(mean / (1 - mean))])]
    m1, m2 = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    for step in range(1, rounds + 1):
        w1, b1, w2, _ = layers
        hidden = np.tanh(x @ w1 + b1)
        d = (1 / (1 + np.exp(-np.clip(hidden @ w2 + layers[3][0], -500, 500))) - y) / len(y)
        back = np.outer(d, w2) * (1 - hidden ** 2)
        grads = [x.T @ back + l2 * w1, back.sum(axis=0), hidden.T @ d + l2 * w2, np.array([d.sum()])]
        for i, g in enumerate(grads):
            m1[i], m2[i] = 0.9 * m1[i] + 0.1 * g, 0.99 * m2[i] + 0.01 * g * g
            layers[i] = layers[i] - 0.02 * (m1[i] / (1 - 0.9 ** step)) / (np.sqrt(m2[i] / (1 - 0.99 ** step)) + 1e-8)
    model.layers = layers
    if len(y_kept):
        z = _logits(layers, x_kept)
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 200))
        loss = [np.mean(np.logaddexp(0, z / t) - y_kept * z / t) for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])


def score(docs: DataFrame, model: Model, score_col: str = "score", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``score_col`` (0 to 1) to every row, over its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return C.map_text(docs, lambda texts: [shared.value.scores(texts).tolist()],
                      T.StructType([T.StructField(score_col, T.DoubleType())]), text_col=text_col, keep=keep)


def held_out(id_col: str = "doc_id"):
    """True for the fold whose labels are never learned (a null id is in no fold)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def op12_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = C.read(spark, sf_dir, "documents"), C.read(spark, sf_dir, "labels")
    model = fit(docs, labels.filter(~held_out()))
    return score(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
