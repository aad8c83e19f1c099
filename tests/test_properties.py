"""Whole-pipeline properties: accounting, order invariance, idempotent re-runs."""

import os

import pytest
from pyspark.sql import functions as F

from riskmart.operators import quality as Q
from riskmart.operators.gold import gold
from riskmart.operators.silver import silver
from riskmart.plans import catalog as C
from riskmart.plans import constants as K
from riskmart.plans import runs as P
from riskmart.session import new_work_dir
from riskmart.sources import files as SRC
from riskmart.sources import fixture as FX


def test_counts_add_up(spark, sf_small):
    raw = C.feed(spark, sf_small)
    n_raw = raw.count()
    outcomes = {r.outcome: r.rows for r in Q.reject_accounting(raw, K.RUN_DATE, K.RUN_TS).collect()}
    assert sum(outcomes.values()) == n_raw
    n_silver = C.silver_df(spark, sf_small).count()
    assert outcomes["accepted"] == n_silver
    assert C.gold_df(spark, sf_small).agg(F.sum("CNT_EVENTS")).first()[0] == n_silver


def test_input_order_does_not_change_results(spark, sf_small):
    ref = C.reference_raw(spark, sf_small)
    feed = C.feed(spark, sf_small)
    shuffled = feed.withColumn("_k", F.rand(7)).repartition(5, "_k").sortWithinPartitions("_k").drop("_k")
    a = gold(silver(feed, ref, K.RUN_DATE, K.RUN_TS))
    b = gold(silver(shuffled, ref, K.RUN_DATE, K.RUN_TS))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rerun_of_a_day_is_idempotent(spark, sf_small):
    root = new_work_dir(spark, "test-rerun")
    FX.land_fixture(spark, sf_small, root)
    cfg = P.RunConfig.under(root, ingestion_ts=K.RUN_TS)
    first = sorted(map(tuple, P.run(spark, cfg).collect()))
    silver_first = P.read_silver(spark, cfg).count()
    again = P.RunConfig(**{**cfg.__dict__, "ingestion_dates": ["2024-01-03", "2024-01-20"]})
    second = sorted(map(tuple, P.run(spark, again).collect()))
    assert first == second
    assert P.read_silver(spark, cfg).count() == silver_first


def test_append_mode_duplicates_and_replace_does_not(spark, sf_small):
    from riskmart.sinks import writers as W
    out = new_work_dir(spark, "test-modes") + "/gold"
    mart = C.gold_df(spark, sf_small)
    n = mart.count()
    W.write_gold(mart, out, mode="replace", days=[K.RUN_DATE])
    W.write_gold(mart, out, mode="replace", days=[K.RUN_DATE])
    assert SRC.read_gold(spark, out).count() == n
    W.write_gold(mart, out, mode="append")
    assert SRC.read_gold(spark, out).count() == 2 * n


def test_quoted_field_keeps_positions(spark, tmp_path):
    line = ["1", "20260101"] + [""] * 56
    line[5] = '"open quote'
    line[6] = "next"
    line[51] = "fr"
    (tmp_path / "gdelt_event_20260101.csv").write_text("\t".join(line) + "\n")
    df = SRC.read_events_file(spark, str(tmp_path))
    row = df.first()
    assert len(df.columns) == 58
    assert row["_c5"] == '"open quote' and row["_c6"] == "next" and row["_c51"] == "fr"


def test_latest_reference_missing_raises(spark, tmp_path):
    import pytest
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        SRC.latest_reference(spark, str(tmp_path / "empty"))


def test_stream_equals_batch(spark, sf_small):
    from riskmart.streaming import incremental as ST
    root = new_work_dir(spark, "test-stream")
    paths = FX.land_fixture(spark, sf_small, root)
    cfg = P.RunConfig.under(root, ingestion_ts=K.RUN_TS)
    P.silver_run(spark, cfg)
    batch = P.read_silver(spark, cfg)
    ref = SRC.latest_reference(spark, paths["reference"])
    ST.run_available(spark, paths["events"], f"{root}/stream_out", f"{root}/_ckpt", K.RUN_TS, ref, max_files_per_trigger=4)
    streamed = ST.read_stream_output(spark, f"{root}/stream_out")
    assert batch.exceptAll(streamed).count() == 0 and streamed.exceptAll(batch).count() == 0


def test_cli_run_and_backfill(spark, sf_small):
    from riskmart.plans import cli
    root = new_work_dir(spark, "test-cli")
    FX.land_fixture(spark, sf_small, root)
    full = cli.main(["--root", root, "--ingestion-ts", K.RUN_TS], spark=spark)
    rows = sorted(map(tuple, full.collect()))
    again = cli.main(["--root", root, "--ingestion-ts", K.RUN_TS, "--backfill-from", "2024-01-10",
                      "--backfill-to", "2024-01-12"], spark=spark)
    assert sorted(map(tuple, again.collect())) == rows
    csv_out = f"{root}/export"
    one = cli.main(["--root", root, "--ingestion-ts", K.RUN_TS, "--ingestion-date", "2024-01-05",
                    "--skip-bronze", "--gold-csv", csv_out], spark=spark)
    exported = SRC.read_gold_csv(spark, csv_out)
    assert exported.count() == one.where(F.col("DTE_INGESTION") == F.lit("2024-01-05").cast("date")).count() > 0


def test_gold_csv_coercion_nulls_bad_cells(spark, tmp_path):
    (tmp_path / "gold.csv").write_text(
        "DTE_EVENT,NAM_COUNTRY,NAM_CITY,CNT_EVENTS,NUM_GOLDSTEIN_AVG,NUM_RISK_SCORE,DTE_INGESTION\n"
        "2024-01-05,FR,Paris,3,-1.5,62.5,2024-01-06\n"
        "2024-02-30,NA,,x,abc,1e2,not-a-date\n")
    rows = SRC.read_gold_csv(spark, str(tmp_path)).orderBy("NAM_COUNTRY").collect()
    bad, good = rows[1], rows[0]
    assert (str(good.DTE_EVENT), good.CNT_EVENTS, good.NUM_GOLDSTEIN_AVG, good.NUM_RISK_SCORE) == \
        ("2024-01-05", 3, -1.5, 62.5)
    assert bad.NAM_COUNTRY == "NA" and bad.NAM_CITY is None
    assert (bad.DTE_EVENT, bad.CNT_EVENTS, bad.NUM_GOLDSTEIN_AVG, bad.DTE_INGESTION) == (None, None, None, None)
    assert bad.NUM_RISK_SCORE == 100.0


def test_failed_replace_leaves_the_stored_day_untouched(spark, sf_small):
    from riskmart.sinks import writers as W
    out = new_work_dir(spark, "replace-fail") + "/gold"
    mart = C.gold_df(spark, sf_small)
    W.write_gold(mart, out, mode="replace", days=[K.RUN_DATE])
    before = sorted(SRC.read_gold(spark, out).collect())
    # a replace whose job fails mid-way (ANSI error while computing the rows)
    broken = mart.withColumn("CNT_EVENTS", (F.col("CNT_EVENTS") / F.lit(0)).cast("bigint"))
    with pytest.raises(Exception):
        W.write_gold(broken, out, mode="replace", days=[K.RUN_DATE])
    assert sorted(SRC.read_gold(spark, out).collect()) == before
    # and a later replace finishes the work; the failed run's folder is gone
    W.write_gold(mart, out, mode="replace", days=[K.RUN_DATE])
    assert sorted(SRC.read_gold(spark, out).collect()) == before
    assert len([n for n in os.listdir(out.removeprefix("file:")) if n.startswith("run=")]) == 2


def test_replace_without_day_list_replaces_exactly_the_written_days(spark, sf_small):
    from riskmart.sinks import writers as W
    out = new_work_dir(spark, "replace-days") + "/gold"
    mart = C.gold_df(spark, sf_small)
    other = mart.withColumn("DTE_INGESTION", F.date_add("DTE_INGESTION", 1))
    W.write_gold(mart.unionByName(other), out, mode="replace")
    n = mart.count()
    assert SRC.read_gold(spark, out).count() == 2 * n
    # replace only the second day (no day list given) by a subset: the first day is untouched
    subset = other.where(F.col("NAM_CITY").isNotNull())
    m = subset.count()
    assert 0 < m < n
    replaced = W.write_gold(subset, out, mode="replace")
    day2 = sorted(r[0] for r in other.select(F.col("DTE_INGESTION").cast("string")).distinct().collect())
    assert replaced == day2
    stored = SRC.read_gold(spark, out)
    assert stored.where(F.col("DTE_INGESTION") == F.lit(K.RUN_DATE).cast("date")).count() == n
    assert stored.where(F.col("DTE_INGESTION") != F.lit(K.RUN_DATE).cast("date")).count() == m
