"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import connection, differences

from pyspark.sql import DataFrameWriter

from workload import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(FOLDER)


def test_every_query_has_a_counterpart():
    assert set(SQL) == set(QUERIES)


def plan_of(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture
def written(monkeypatch):
    """(path, plan) of everything that is written on the way."""
    found = []
    plain = DataFrameWriter.parquet

    def parquet(self, path, *args, **options):
        found.append((path, plan_of(self._df)))
        return plain(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return found


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, written, name):
    df = QUERIES[name](spark, FOLDER)
    for path, plan in [*written, ("result", plan_of(df))]:
        for unwanted in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "PythonUDF", "MapInPandas", "ObjectHashAggregate"):
            assert unwanted not in plan or (name, unwanted) in ALLOWED, (unwanted, path)
        assert "/ranked-" not in path or "Window" not in plan
    assert differences(df, con, SQL[name]) == []


# The few heads per group, the lists of the landed documents, the pieces of one entry, sketches, and the bins of an exact
# sum, of which a class has at most 106 when they are gathered.
GATHERED = (
    "peers_top3", "peers_rebased", "calendar_section", "large_document", "sketch_quantiles", "group_stats", "efficiency_metrics",
    "impact_comparison", "carbon_efficiency_metrics", "environmental_impact_comparison", "revenue_by_grain", "period_summary",
    "published_layers", "declared_checks",
)
ALLOWED = {(name, "ObjectHashAggregate") for name in GATHERED}


def test_only_what_is_needed_is_written(spark, written):
    QUERIES["int_stock_metrics"](spark, FOLDER)
    assert not [path for path, _ in written if "customer_base" in path]
    written.clear()
    QUERIES["stg_coincap_prices"](spark, FOLDER)
    assert len(written) == 1


@pytest.mark.parametrize("name, table", [("keep_first_duplicate", "lineitem"), ("payload_split", "customer"), ("valid_shape", "events")])
def test_one_pass_over_the_input(spark, name, table):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1


def test_bounds_reach_the_scan(spark):
    plan = plan_of(QUERIES["fixed_date_range"](spark, FOLDER))
    assert "GreaterThanOrEqual(l_shipdate,1997-02-13T00:00)" in plan and "LessThan(l_shipdate,1997-02-24T00:00)" in plan
    assert "ReadSchema: struct<l_returnflag:string,l_shipdate:timestamp_ntz>" in plan


def test_ranked_classes_need_no_window_over_the_detail(spark):
    for name in ("efficiency_metrics", "rank_in_large_class", "carbon_efficiency_metrics"):
        assert "Window" not in plan_of(QUERIES[name](spark, FOLDER))


def test_series_measures_share_one_window(spark):
    plan = plan_of(QUERIES["moving_averages"](spark, FOLDER))
    assert plan.count(") Window") == 1 and plan.count(") Exchange") == 2
