"""Physical-plan shape: the properties that matter at scale."""

import io
from contextlib import redirect_stdout

from riskmart.operators import bi
from riskmart.plans import catalog as C
from riskmart.plans import runs as P
from riskmart.session import new_work_dir
from riskmart.sources import files as SRC
from riskmart.sources import fixture as FX


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_dedup_limits_before_shuffle(spark, sf_small):
    p = plan(C.QUERIES["dup_events"](spark, sf_small))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_scan_is_pruned(spark, sf_small):
    p = plan(C.silver_df(spark, sf_small))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p


def test_gold_aggregate_is_two_phase(spark, sf_small):
    p = plan(C.gold_df(spark, sf_small), "simple")
    assert p.count("HashAggregate") >= 2 and "partial_sum" in p


def test_top_k_is_take_ordered(spark, sf_small):
    p = plan(bi.top_cities(C.gold_df(spark, sf_small)), "simple")
    assert "TakeOrderedAndProject" in p


def test_day_reads_prune_partitions(spark, sf_small):
    root = new_work_dir(spark, "test-prune")
    paths = FX.land_fixture(spark, sf_small, root)
    p = plan(SRC.read_events(spark, paths["events"], ingestion_dates=["2024-01-05"]), "simple")
    assert "PartitionFilters: [isnotnull(ingestion_date" in p and "2024-01-05" in p
    cfg = P.RunConfig.under(root, ingestion_ts="t", ingestion_dates=["2024-01-05", "2024-01-06"])
    P.silver_run(spark, cfg)
    # the folders of other days are not even listed
    files = P.read_silver(spark, cfg, ["2024-01-05"]).inputFiles()
    assert files and all("ingestion_date=2024-01-05" in f for f in files)
    assert len(P.read_silver(spark, cfg).inputFiles()) > len(files)


def test_no_single_partition_window(spark, sf_small):
    for key in ("score_proposed", "prof_describe", "dq_rejects", "gold_mart", "silver_enriched"):
        p = plan(C.QUERIES[key](spark, sf_small), "simple")
        # a window without PARTITION BY would gather every row in one task
        assert "Window [" not in p or "SinglePartition" not in p.split("Window [", 1)[1].split("\n", 3)[0], key


def test_reference_join_is_broadcast_by_its_run_time_size(spark, sf_small):
    df = C.silver_df(spark, sf_small)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p.split("== Initial Plan ==")[0]


def test_building_a_plan_runs_no_job(spark, sf_small):
    from riskmart.operators import analysis as A
    stored = C.stored_gold(spark, sf_small)
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    C.silver_df(spark, sf_small)
    A.proposed_score(stored)
    A.score_correlation(stored)
    assert set(tracker.getJobIdsForGroup(None)) == before


def test_stored_gold_prunes_folders(spark, sf_small):
    p = plan(bi.country_by_day(C.stored_gold(spark, sf_small), "2024-01-15"), "simple")
    assert "PartitionFilters: [isnotnull(DTE_EVENT" in p
