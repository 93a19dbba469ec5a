"""Memory of one task: partitions follow the number of rows."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobledger.catalog import QUERIES
from jobledger.plans import strategy

N = 400  # orders, with 1 to 5 lines each


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    t = dt.datetime(1997, 1, 1)
    out = tmp_path_factory.mktemp("lines")
    orders = [(k, k % 9, "FOP"[k % 3], 90_000.0 + 700 * k, f"{k % 5 + 1}-X") for k in range(N)] + [(None, 1, "F", 1.0, "1-X")]
    rows = [(k if k else None, k * i % 11, k % 7, i, 8.0 * i + k % 5, "RNA"[i % 3], "OF"[k % 2], t, 10.0 * i) for k in range(N) for i in range(1, k % 5 + 2)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string").write.parquet(f"{out}/orders.parquet")
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz, l_extendedprice double").write.parquet(f"{out}/lineitem.parquet")
    return str(out), len(rows)


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k) for k in keys]
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in zip(keys, before):
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["create_workflows", "expand_workflows", "workflow_requests", "ready_steps"])
def test_tasks_hold_a_bounded_number_of_lines(spark, lines, monkeypatch, no_broadcast, name):
    folder, n = lines
    whole = QUERIES[name](spark, folder)
    monkeypatch.setattr(strategy, "TASK_ROWS", 30)
    parted = QUERIES[name](spark, folder)
    got = parted.withColumn("_part", F.spark_partition_id()).collect()
    assert sorted(str(r[:-1]) for r in got) == sorted(str(tuple(r)) for r in whole.collect())
    sizes = Counter(r["_part"] for r in got)
    assert len(sizes) > n / 30 * 0.7 and max(sizes.values()) < 200
