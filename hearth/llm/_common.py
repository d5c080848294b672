"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import io
import zipfile
from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.session import scratch_table_path

# Text is handled inside a task in pieces of about this many characters, so a
# task's memory does not depend on how many rows Arrow puts into a batch.
CHUNK_CHARS = 1 << 20


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, once a session: a zip in the
    shared folder.  Functions that run in tasks are looked up by module name."""
    sc = spark.sparkContext
    if getattr(sc, "_hearth_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(f.relative_to(root.parent)))
    path = scratch_table_path(spark, "package") + "/hearth.zip"
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(data.getvalue()))
    out.close()
    sc.addPyFile(path)
    sc._hearth_shipped = True


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, name: str, path: str | None = None, **options: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder (``path``: one there): later
    steps read the files, so a lost executor never repeats what led to them.
    ``options``: of the writer."""
    spark = df.sparkSession
    ship_package(spark)
    path = path or scratch_table_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unwritten(spark: SparkSession, path: str) -> None:
    """Give the disk of a written table back, when its last reader has ended."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns ``id`` (long) and ``text`` (null text: empty), whatever else the table holds."""
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def slices(column: pa.Array, chars: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """(start, stop) of slices of a text column holding about ``chars`` bytes each."""
    n, start, used = len(column), 0, 0
    lengths = pc.binary_length(column).fill_null(0).to_pylist()
    for i in range(n):
        used += lengths[i]
        if used >= chars or i == n - 1:
            yield start, i + 1
            start, used = i + 1, 0


def chunks(column: pa.Array, chars: int = CHUNK_CHARS) -> Iterator[tuple[int, list]]:
    """Slices (start, values) of a text column holding about ``chars`` bytes each."""
    column = column.fill_null("")
    for start, stop in slices(column, chars):
        yield start, column.slice(start, stop - start).to_pylist()


def map_text(df: DataFrame, fn: Callable[[list[str]], list], out: T.StructType, text_col: str = "text",
             keep: list[str] | None = None, done: Callable[[], None] | None = None) -> DataFrame:
    """Run ``fn`` over the texts of ``df`` (lists of about a megabyte) and
    append its columns.  ``fn`` returns one list per field of ``out``.  A null
    text reaches ``fn`` as the empty text.  ``keep`` names the input columns
    that stay (default: all).  ``done`` is called when a task has read its rows:
    a worker that goes on to other work should not hold on to memory."""
    ship_package(df.sparkSession)
    keep = list(df.columns) if keep is None else keep
    df = df.select(*dict.fromkeys([*keep, text_col]))
    schema = T.StructType([df.schema[c] for c in keep] + list(out.fields))
    from pyspark.sql.pandas.types import to_arrow_schema
    added = to_arrow_schema(out)

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            parts: list[list] = [[] for _ in added]
            for _, texts in chunks(column):
                for part, values in zip(parts, fn(texts)):
                    part.extend(values)
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            names = list(keep)
            for field, part in zip(added, parts):
                arrays.append(pa.array(part, field.type))
                names.append(field.name)
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        if done:
            done()
        let_go()

    return df.mapInArrow(run, schema)


def let_go() -> None:
    """Give a task's freed memory back: an idle Python worker should not hold on
    to what its last task needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc only
    if trim:
        trim(0)


def one_row_per_key(df: DataFrame, *key: str) -> DataFrame:
    """``df`` with one row for each value of the columns ``key`` (null is a value
    too).  Keys that occur once -- normally all of them -- pass without a shuffle
    of the rows."""
    own = [f"__k{i}" for i in range(len(key))]
    again = df.groupBy(*[F.col(k).alias(o) for k, o in zip(key, own)]).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(*own)
    again = written(again, "repeated-keys")
    if again.isEmpty():
        return df
    same = reduce(and_, [df[k].eqNullSafe(again[o]) for k, o in zip(key, own)])
    once = df.join(again, same, "left_anti")
    more = df.join(again, same, "left_semi").dropDuplicates(list(key))
    return once.unionByName(more)


def likely_among(df: DataFrame, on: list[Column], keys: DataFrame, most_bits: int = 1 << 24) -> tuple[DataFrame, DataFrame]:
    """``df`` in two parts, without moving a row: those whose columns ``on`` may
    stand in ``keys`` (every one that does and about one in 32 others; more, when
    the keys outgrow ``most_bits``), and those that surely do not.  A join need
    only move the first.  One bit for each key, at most 262,144 words, is broadcast."""
    bits = min(most_bits, 64 * max(keys.count(), 1))         # 64 bits make a word
    place = F.pmod(F.xxhash64(*keys.columns), F.lit(bits))
    words = written(keys.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("__word"))
                    .agg(F.expr("bit_or(shiftleft(1L, CAST(p & 63 AS INT)))").alias("__bits")), "key-bits")
    x = df.withColumn("__place", F.pmod(F.xxhash64(*on), F.lit(bits)))
    x = x.join(F.broadcast(words), F.shiftright("__place", 6) == F.col("__word"), "left")
    hit = F.coalesce(F.getbit("__bits", F.col("__place").bitwiseAND(F.lit(63)).cast("int")), F.lit(0)) == 1
    some, rest = x.where(hit), x.where(~hit)
    return some.select(*df.columns), rest.select(*df.columns)
