"""The log stream against batch compaction."""

import random

from clipspans.operators import results
from clipspans.streaming import compact

SCHEMA = "row_key string, line_no bigint, ok boolean, error string, parse_error string, evaluation map<string,string>, at timestamp"


def drawn(r, first, n, keys=12):
    import datetime

    out = []
    for i in range(n):
        ok = r.random() < 0.4
        out.append((None if r.random() < 0.15 else f"k{r.randrange(keys)}", first + i, ok, None if ok else r.choice(["e", None]), None, {"a": str(i), "b": None} if r.random() < 0.8 else {}, datetime.datetime(2024, 1, 2, 3, 4, 5, r.randrange(10**6))))
    return out


def rows(df):
    return sorted((str(tuple(x)) for x in df.collect()))


def test_state_equals_batch_compaction(spark, tmp_path):
    """After each of ten batches, also where parts come late; every call takes in only what is new, and the state outlives its stream."""
    r = random.Random(8)
    log, state, checkpoint = f"{tmp_path}/log", f"{tmp_path}/state", f"{tmp_path}/cp"
    so_far, costs = [], []
    order = list(range(10))
    r.shuffle(order)
    for k in order:
        part = drawn(r, 1000 * k, 30)
        so_far += part
        spark.createDataFrame(part, SCHEMA).coalesce(2).write.mode("append").json(log)
        keyed, unkeyed = compact.update_state(spark, log, SCHEMA, state, checkpoint)
        costs.append((sum(p["numInputRows"] for p in keyed.recentProgress), sum(p["numInputRows"] for p in unkeyed.recentProgress)))
        if k in order[::3]:
            # the log as it is read, since JSON has no null values in maps
            want = results.compact_results(spark.read.schema(SCHEMA).json(log))
            assert rows(compact.compacted(spark, SCHEMA, state, checkpoint)) == rows(want)
    assert [a for a, _ in costs] == [30] * 10 and all(b <= 30 for _, b in costs)
    assert rows(compact.compact_stream(spark, log, SCHEMA, state, checkpoint)) == rows(results.compact_results(spark.read.schema(SCHEMA).json(log)).drop("position"))


def test_settings_and_small_batches(spark, tmp_path):
    before = {k: spark.conf.get(k, None) for k in compact.STATE_CONF}
    (tmp_path / "none").mkdir()
    assert compact.compact_stream(spark, f"{tmp_path}/none", SCHEMA, f"{tmp_path}/s0", f"{tmp_path}/c0").count() == 0
    part = drawn(random.Random(1), 0, 200, keys=3)
    spark.createDataFrame(part, SCHEMA).repartition(5).write.json(f"{tmp_path}/log")
    keyed, _ = compact.update_state(spark, f"{tmp_path}/log", SCHEMA, f"{tmp_path}/s", f"{tmp_path}/c", files_per_batch=1)
    assert len([p for p in keyed.recentProgress if p["numInputRows"]]) == 5
    assert rows(compact.compacted(spark, SCHEMA, f"{tmp_path}/s", f"{tmp_path}/c")) == rows(results.compact_results(spark.read.schema(SCHEMA).json(f"{tmp_path}/log")))
    assert {k: spark.conf.get(k, None) for k in compact.STATE_CONF} == before
