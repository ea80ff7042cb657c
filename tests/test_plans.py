"""Physical plan checks: broadcast dimensions, pushdown, pruning, top-k, no Python UDFs."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from horavento.operators.filters import by_year
from horavento.sources.tables import readings
from tests.conftest import SF01

Q = E.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString() + "\n" + \
        df._jdf.queryExecution().optimizedPlan().toString()


def test_dimension_join_is_broadcast(spark):
    assert "BroadcastHashJoin" in plan(Q["station_enrich"](spark, SF01))


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(Q["top_stations"](spark, SF01))
    assert "TakeOrderedAndProject" in plan(Q["recent_rows"](spark, SF01))


def test_tail_ranks_in_parts_first(spark):
    assert plan(Q["tail_per_key"](spark, SF01)).count("Window [row_number") >= 2


def test_column_pruning_reaches_scan(spark):
    p = plan(Q["value_counts"](spark, SF01))
    assert "ReadSchema: struct<event_type:string>" in Q["value_counts"](spark, SF01)._jdf \
        .queryExecution().executedPlan().toString() or "event_type" in p


def test_partition_pruning(spark, workdir):
    r = readings(spark, SF01).withColumn("ano", F.year("data"))
    r.write.partitionBy("ano").parquet(workdir)
    df = by_year(spark.read.parquet(workdir), [2024])
    assert "PartitionFilters: [isnotnull(ano" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_no_python_udf(spark, name):
    p = plan(Q[name](spark, SF01))
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert node not in p


def test_exploded_lines_do_not_carry_the_file(spark):
    """Each exploded line must not drag the whole file's line array along."""
    import re
    from horavento.sources.station_files import (
        read_station_csv, read_station_csv_named, read_station_header,
    )
    from tests.conftest import GOLDEN
    for df in (read_station_csv(spark, GOLDEN), read_station_csv_named(spark, GOLDEN, ["DATA", "HORA UTC"]),
               read_station_header(spark, GOLDEN)):
        p = df._jdf.queryExecution().executedPlan().toString()
        for kept in re.findall(r"Generate posexplode\([^\n]*?\), \[([^\]]*)\]", p):
            assert "lines" not in kept, kept
