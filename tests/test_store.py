"""The keyed store: a key is replaced as a whole or not at all."""

import pytest
from pyspark.sql import functions as F

from tallyspark.sinks.store import IncompleteStore, KeyedStore
from tallyspark.session import remove_path


@pytest.fixture()
def store(spark, tmp_path):
    return KeyedStore(spark, str(tmp_path / "store"), ["day"])


def frame(spark, rows):
    return spark.createDataFrame(rows, "day int, metric string, value double").repartition(3)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_commit_replaces_its_keys_only(spark, store):
    assert not store.exists()
    store.replace(frame(spark, [(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0)]))
    store.replace(frame(spark, [(2, "a", 30.0), (2, "b", 40.0), (3, "a", 5.0)]))
    assert rows(store.verified()) == [(1, "a", 1.0), (1, "b", 2.0), (2, "a", 30.0), (2, "b", 40.0), (3, "a", 5.0)]


def test_a_killed_write_leaves_the_old_day(spark, store):
    store.replace(frame(spark, [(1, "a", 1.0)]))
    store.write(frame(spark, [(1, "a", 9.0), (1, "b", 9.0)]))  # dies before its commit
    assert rows(store.verified()) == [(1, "a", 1.0)]

    def fail(x):
        raise RuntimeError("executor lost")

    bad = frame(spark, [(1, "a", 9.0)]).withColumn("value", F.udf(fail, "double")("value"))
    with pytest.raises(Exception, match="executor lost"):
        store.replace(bad)
    assert rows(store.verified()) == [(1, "a", 1.0)]
    assert store.vacuum() >= 1
    assert rows(store.verified()) == [(1, "a", 1.0)]


def test_an_announced_key_can_become_empty(spark, store):
    store.replace(frame(spark, [(1, "a", 1.0), (2, "a", 2.0)]))
    keys = spark.createDataFrame([(1,), (2,)], "day int")
    store.replace(frame(spark, [(2, "a", 20.0)]), keys)
    assert rows(store.verified()) == [(2, "a", 20.0)]
    store.replace(frame(spark, []), keys)
    assert rows(store.verified()) == []


def test_commits_side_by_side_give_one_winner(spark, store):
    store.replace(frame(spark, [(1, "a", 1.0)]))
    first, second = store.write(frame(spark, [(1, "a", 2.0)])), store.write(frame(spark, [(1, "a", 3.0)]))
    store.commit(first)
    # the second writer had read the log before the first one's commit: same sequence number
    last = store.commits().where(F.col("run") == first).withColumn("run", F.lit(second))
    last.coalesce(1).write.mode("append").parquet(store.log)
    assert rows(store.verified()) == [(1, "a", 3.0 if second > first else 2.0)]


def test_lost_rows_are_an_error(spark, store):
    run = store.replace(frame(spark, [(1, "a", 1.0), (2, "a", 2.0)]))
    store.replace(frame(spark, [(2, "a", 3.0)]))
    remove_path(spark, f"{store.data}/run={run}")
    assert rows(store.check().select("day", "rows", "found")) == [(1, 1, 0)]
    with pytest.raises(IncompleteStore):
        store.verified()
