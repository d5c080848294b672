import datetime as dt
import os
import tempfile

from hearth.plans.flat import lookups
from hearth.schemas import SOURCE, struct
from hearth.streaming import incremental_load, obs_decoder

from .emr_fixture import build

T = dt.datetime


def test_incremental_obs_append_is_exactly_once(spark):
    src = build(spark)
    lk = lookups(src)
    base = tempfile.mkdtemp(prefix="hearth-stream-")
    inp, out, ckpt = (os.path.join(base, d) for d in ("in", "out", "ckpt"))
    schema = struct(SOURCE["obs"])
    obs = src["obs"]
    obs.where("obs_id <= 10").write.parquet(os.path.join(inp, "b1"))
    # one file set per batch directory; the stream reads the parent with recursive lookup
    spark.conf.set("spark.sql.streaming.schemaInference", "false")
    run = lambda: incremental_load(spark, inp + "/*", schema, obs_decoder(lk, prefix="7"), out, ckpt)
    run()
    first = spark.read.parquet(out)
    n1 = first.count()
    assert n1 == obs.where("obs_id <= 10 and not voided").count()
    assert first.where("value_coded = 'TDF/3TC/EFV'").count() == 1
    assert all(str(r["obs_id"]).startswith("7") for r in first.collect())
    run()                                           # nothing new: nothing appended
    assert spark.read.parquet(out).count() == n1
    obs.where("obs_id > 10").write.parquet(os.path.join(inp, "b2"))
    run()
    final = spark.read.parquet(out)
    # without a checkpoint path the sink keeps its own, from call to call
    out2 = os.path.join(base, "out2")
    again = lambda: incremental_load(spark, inp + "/*", schema, obs_decoder(lk, prefix="7"), out2)
    again()
    obs.where("obs_id <= 10").write.parquet(os.path.join(inp, "b3"))
    again()
    assert spark.read.parquet(out2).count() == final.count() + n1
    assert final.count() == obs.where("not voided").count()
    assert final.select("obs_id").distinct().count() == final.count()
