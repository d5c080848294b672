"""SpotSigs fingerprints, with DataFrame functions only.

A spot signature is an anchor -- one of the corpus's most common words, or, so
that tables and lists have spots too, a word whose hash falls on one value in
``extra`` -- and the ``chain`` content words (words that are no anchors) that
follow it.  A
text's fingerprint is the sorted set of its signatures' 32-bit hashes, written
as hex.  Likeness is the Jaccard of two given sets.  The method's search for
near duplicates (sets partitioned by length and joined) is left out.

The edited text of the query needs each document's successor by id.  The ids
are cut into ranges at approximate quantiles; each range also gets the first
document of the next one, so a window inside the range finds every successor.

Defined results: a null text is empty; a text without an anchor before a
content word has one signature, of its whole word sequence (equal texts are
alike 1, others 0); repeated ids stand in order of their texts' hashes; null
ids come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm import _common as C

WORD_BREAK = r"[^\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WORD_BREAK), lambda x: x != "")


def common_words(docs: DataFrame, anchors: int = 200, text_col: str = "text") -> list[str]:
    """The ``anchors`` most frequent words over all texts (ties: by word)."""
    each = docs.select(F.explode(_words(F.col(text_col))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return [r["w"] for r in each.orderBy(F.col("n").desc(), "w").limit(anchors).collect()]


def with_signatures(df: DataFrame, text_col: str, out_col: str, common: list[str], chain: int = 2,
                    extra: int = 8) -> DataFrame:
    """Append ``out_col``: the sorted set of the text's signatures (int)."""
    def is_common(x):
        chosen = F.pmod(F.xxhash64(x), F.lit(extra)) == 0
        return x.isin(common) | chosen if common else chosen

    keep = df.columns
    # three steps, so that no array is made anew inside another's function
    df = df.select(*keep, _words(F.col(text_col)).alias("__w"))
    df = df.select(*keep, "__w", F.filter("__w", lambda x: ~is_common(x)).alias("__c"),
                   F.filter(F.transform("__w", lambda x, i: F.when(is_common(x), i).otherwise(-1)), lambda i: i >= 0).alias("__a"))
    # the k-th anchor stands at word i, so i - k content words stand before it
    spots = F.transform(F.filter(F.transform("__a", lambda i, k: F.struct(i.alias("i"), (i - k).alias("c"))),
                                 lambda x: x["c"] < F.size("__c")),
                        lambda x: _int(F.xxhash64(F.get("__w", x["i"]), *[F.get("__c", x["c"] + j) for j in range(chain)])))
    whole = F.array(_int(F.xxhash64(F.array_join("__w", " "))))
    df = df.select(*keep, F.when(F.size("__a") > 0, F.array_sort(F.array_distinct(spots))).otherwise(F.array().cast("array<int>")).alias("__s"),
                   whole.alias("__whole"))
    return df.select(*keep, F.when(F.size("__s") > 0, F.col("__s")).otherwise(F.col("__whole")).alias(out_col))


def _int(h: Column) -> Column:
    return F.shiftright(h, 32).cast("int")


def fingerprint(signatures: Column) -> Column:
    """The set as text: eight hex digits a signature, in order."""
    return F.array_join(F.transform(signatures, lambda x: F.lower(F.right(F.lpad(F.hex(x), F.lit(16), F.lit("0")), F.lit(8)))), "")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard of two signature sets; 0 where the lengths alone keep it below ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    full = both / (F.size(a) + F.size(b) - both)
    return F.when(a == b, F.lit(1.0)).when(small < large * F.lit(least), F.lit(0.0)).otherwise(full).cast("double")


def with_next(docs: DataFrame, range_rows: int = 2_000, most_ranges: int = 16_384) -> DataFrame:
    """``docs`` (id, text).  Returns (id, text, next): the text of the next row by id, after the last the first."""
    key = F.coalesce("id", F.lit(-2**63))
    docs = docs.select("id", "text", key.alias("key"))
    n = docs.count()
    ranges = max(1, min(most_ranges, n // range_rows))
    bounds = docs.agg(F.percentile_approx("key", [i / ranges for i in range(1, ranges)] or [0.5], 50 * ranges).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))[:ranges]
    steps, step = [], 1
    while step <= len(bounds):
        steps.append(step)
        step *= 2
    at = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<bigint>")
    # how many bounds are not above the key: a binary search
    place = F.aggregate(F.array(*[F.lit(s) for s in reversed(steps)]) if steps else F.array().cast("array<int>"), F.lit(0),
                        lambda lo, s: F.when(F.get(at, lo + s - 1) <= F.col("key"), lo + s).otherwise(lo))
    docs = docs.withColumn("range", place)
    firsts = docs.groupBy("range").agg(F.min("key").alias("first")).orderBy("range").collect()     # one row a range
    if not firsts:
        return docs.select("id", "text", F.lit("").alias("next"))
    guests = docs.sparkSession.createDataFrame(
        [(r["first"], firsts[i - 1]["range"]) for i, r in enumerate(firsts)], "first long, host int")
    visiting = docs.join(F.broadcast(guests), F.col("key") == F.col("first")) \
        .select("id", "text", "key", F.col("host").alias("range"), F.lit(1).alias("guest"))
    rows = docs.select("id", "text", "key", "range", F.lit(0).alias("guest")).union(visiting)
    w = Window.partitionBy("range").orderBy("guest", "key", F.xxhash64("text"), "text")
    return rows.withColumn("next", F.lead("text").over(w)).filter("guest = 0").select("id", "text", "next")


def op1_spotsigs(spark, sf_dir: str) -> DataFrame:
    docs = C.id_and_text(C.read(spark, sf_dir, "documents"))
    common = common_words(docs)
    df = with_next(docs)
    half = F.floor(F.length("text") / 2).cast("int")
    df = df.select("id", "text", F.length("text").cast("long").alias("n_chars"), "next", F.concat(
        F.substring("text", F.lit(1), F.length("text") - half), F.substring("next", F.lit(1), half)).alias("edited"))
    df = with_signatures(df, "text", "own", common).drop("text")
    df = with_signatures(df, "next", "after", common).drop("next")
    df = with_signatures(df.withColumn("edited_sha256", F.sha2("edited", 256)), "edited", "changed", common).drop("edited")
    return df.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
                     fingerprint(F.col("changed")).alias("edited_fingerprint"),
                     likeness(F.col("own"), F.col("changed")).alias("near_edited"),
                     likeness(F.col("own"), F.col("after")).alias("near_next"))
