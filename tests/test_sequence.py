"""Numbering in parts equals the plain window, wherever the parts are cut."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortweave.operators import sequence
from cohortweave.operators.sequence import nulls_last, sequence_within


def _frame(spark, seed, n=300, spread=1):
    rng = random.Random(seed)
    ids = [i * spread - (1 << 62) for i in rng.sample(range(n * 3), n)]
    data = [(rng.choice([None, "a", "a", "a", f"k{i}"]), rng.choice([None, 1, 2, 3]), ids[i],
             rng.choice([None, None, None, f"v{i}"]), rng.randint(0, 4)) for i in range(n)]
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "k string, visit int, id long, v string, w int")


def walk(data):
    want = {}
    for key in {r[0] for r in data}:
        group = sorted((r for r in data if r[0] == key), key=lambda r: (r[1] is None, r[1] or 0, r[2]))
        total, filled, last = 0, [], None
        for place, (_, _, id_, v, w) in enumerate(group):
            last = v if v is not None else last
            filled.append([id_, place, total, last])
            total += w
        following = None
        for (_, _, _, v, _), row in zip(reversed(group), reversed(filled)):
            following = v if v is not None else following
            row[3] = row[3] if row[3] is not None else following
        want.update({row[0]: tuple(row[1:]) for row in filled})
    return want


@pytest.mark.parametrize("seed,split_above,parts,spread", [(1, 0, 7, 1), (2, 0, 64, 1 << 51), (3, 1000, 4, 1), (4, 0, 1, 1 << 40)])
def test_matches_sequential_walk(spark, monkeypatch, seed, split_above, parts, spread):
    """Sparse 64-bit ids, a null key and a key that hold most rows, groups of one row."""
    monkeypatch.setattr(sequence, "SAMPLED", 20 if parts < 10 else 4)
    data, df = _frame(spark, seed, spread=spread)
    got = sequence_within(
        df, keys=["k"], order=[*nulls_last(F.col("visit")), "id"], before={"place": F.lit(1), "total": F.col("w")},
        fills={"v": F.col("v")}, split_above=split_above, parts=parts).collect()
    assert {r.id: (r.place, r.total, r.v) for r in got} == walk(data) and len(got) == len(data)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_no_keys_is_one_group(spark, kind):
    """Sparse numbers and texts in the order; as many parts as asked for, of about one size."""
    df = spark.range(4000).select((F.xxhash64("id") if kind == "long" else F.hex(F.xxhash64("id"))).alias("id"))
    numbered = sequence_within(df, keys=[], order=["id"], before={"n": F.lit(1)}, split_above=0, parts=8)
    got = [r.id for r in sorted(numbered.collect(), key=lambda r: r.n)]
    assert got == sorted(got) and len(got) == 4000
    assert sorted(r.n for r in numbered.collect()) == list(range(4000))


def test_hot_group_is_spread_over_tasks(spark):
    """One key holding most rows lands in parts of about one size; the others are not cut."""
    df = spark.range(1 << 14).select(F.when(F.col("id") % 10 > 0, "one").otherwise(F.concat(F.lit("k"), "id")).alias("k"), F.xxhash64("id").alias("id"))
    body = df.select("*", F.col("id").alias("_o0"))
    large, cuts = sequence._cuts(body, 1 << 14, ["k"], ["_o0"], 16)
    assert large == [("one",)] and len(cuts) == 15
    sizes = Counter(r[0] for r in df.select("k", F.col("id").alias("_o0")).withColumn("p", sequence._part(body, ["k"], ["_o0"], large, cuts))
                    .where("k = 'one'").select("p").collect())
    assert len(sizes) == 16 and max(sizes.values()) < 3 * min(sizes.values())


def test_input_is_evaluated_once(spark, tmp_path):
    """The plan reads the staged table only, each time; totals read no more than the columns they need."""
    spark.range(500).selectExpr("id % 3 AS k", "id", "repeat('x', 50) AS wide").write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    counted = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    done = sequence_within(df.mapInArrow(count, df.schema), keys=["k"], order=["id"], before={"n": F.lit(1)}, split_above=0, parts=4)
    assert done.count() == 500 and len(done.collect()) == 500
    assert counted.value == 500
    assert str(tmp_path) not in done._jdf.queryExecution().toString()


def test_more_rows_are_more_tasks(spark, monkeypatch):
    _, df = _frame(spark, 5)
    want = {r["id"]: r["at"] for r in sequence_within(df, ["k", "visit"], ["id"], {"at": F.lit(1)}).collect()}
    monkeypatch.setattr(sequence, "TASK_ROWS", 20)
    for split_above in (None, 0):  # no group is large; large ones are cut
        got = sequence_within(df, ["k", "visit"], ["id"], {"at": F.lit(1)}, split_above=split_above, parts=4)
        assert got.rdd.getNumPartitions() == 15
        assert {r["id"]: r["at"] for r in got.collect()} == want
