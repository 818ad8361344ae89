"""Plan properties the operators rely on at scale (read from explain output)."""

import contextlib
import io

import __spark_entry__ as E

from .conftest import SF_SMALL


def plan(df, mode="simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(E.queries()["clean_records"](spark, SF_SMALL), "formatted")
    assert "PushedFilters: [IsNotNull(l_discount), IsNotNull(l_returnflag), " \
           "Not(EqualTo(l_discount,0.0)), Not(EqualTo(l_returnflag,R))]" in p
    read = [line for line in p.splitlines() if line.startswith("ReadSchema")][0]
    assert "l_shipdate" not in read and "l_suppkey" not in read


def test_top_k_is_take_ordered(spark):
    for name in ("top_tags", "top_entities"):
        assert "TakeOrderedAndProject" in plan(E.queries()[name](spark, SF_SMALL))


def test_correlation_is_one_aggregate_without_a_generator_below(spark):
    p = plan(E.queries()["correlation_matrix"](spark, SF_SMALL))
    assert p.count("FileScan parquet") == 1
    assert "Generate" not in p[p.index("partial_sum"):]


def test_orders_are_aggregated_before_the_customer_join(spark):
    p = plan(E.queries()["top_entities"](spark, SF_SMALL))
    join = p.index("BroadcastHashJoin")
    assert "partial_count(1)" in p[join:]          # the per-customer count sits below the join


def test_no_single_task_percentile_aggregate(spark):
    p = plan(E.queries()["percentile_75"](spark, SF_SMALL))
    assert "percentile(" not in p.replace("percentile_75", "")
    assert "_tl_pid" not in p


def test_percentile_sorts_only_the_bracket(spark):
    from trendlens.operators import profile
    rows = spark.range(2_000_000).selectExpr("if(id % 3 = 0, 7.0D, cast(id as double)) as x")
    p = plan(profile.percentile(rows, "x", 0.9), "extended")
    assert ">=" in p and "<=" in p                  # the values are filtered before they are counted
    assert abs(profile.percentile(rows, "x", 0.9).first()[0] - rows.selectExpr("percentile(x, 0.9)").first()[0]) < 1e-9
    assert profile.percentile(rows, "x", 0.2).first()[0] == 7.0


def test_label_index_ranks_without_a_third_shuffle(spark):
    p = plan(E.queries()["index_categories"](spark, SF_SMALL))
    assert "hashpartitioning(_tl_pid" not in p.replace("#", "").split("MapInArrow")[0] and "MapInArrow" in p


def test_small_dimension_is_broadcast_by_the_planner(spark):
    assert "BroadcastHashJoin" in plan(E.queries()["counts_by_category"](spark, SF_SMALL))


def test_no_vector_buffers_meet_in_one_task(spark):
    from trendlens.ml import features, models
    from trendlens.plans import features as PF
    spec = features.FeatureSpec(num_features=1024)
    tr, _ = models.split(features.build_features(PF.records(spark, SF_SMALL), PF.ROLES), "video_id")
    buckets = features.active_buckets(spec, tr)
    assert buckets == sorted(set(buckets)) and 0 < len(buckets) <= 1024
    import inspect
    assert "Summarizer" not in inspect.getsource(features)
