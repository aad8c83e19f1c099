"""Runs, staged writes, streams and sums in the cases that used to go wrong."""

import math
import os
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import raw_rows
from riskmart import fs
from riskmart.operators import quality as Q
from riskmart.operators.gold import exact_avg, exact_sum, gold
from riskmart.operators.silver import silver
from riskmart.plans import arrival, cli
from riskmart.plans import constants as K
from riskmart.plans import runs as P
from riskmart.session import new_work_dir
from riskmart.sinks import writers as W
from riskmart.sources import files as SRC
from riskmart.sources import fixture as FX
from riskmart.streaming import incremental as ST

REFERENCE = "country string, baseline_risk string, risk_multiplier string, updated_at string"


def local(path):
    return path.removeprefix("file:")


# --- sums --------------------------------------------------------------------
@pytest.mark.parametrize("value", [4e-7, 1e-7, 62.504, 1e9, 1e14, -3.25, 1.0000000001])
def test_sums_keep_small_and_large_values(spark, value):
    df = spark.range(1000).select(F.lit(value).alias("x")).repartition(7)
    total, mean = df.agg(exact_sum("x"), exact_avg("x")).first()
    assert total == pytest.approx(1000 * value, rel=1e-12) and mean == pytest.approx(value, rel=1e-12)


def test_sums_outside_the_integers(spark):
    big = spark.range(20_000).select(F.lit(9.9e8).alias("x"))       # 2e19 units: more than 64 bits
    assert big.agg(exact_sum("x")).first()[0] == pytest.approx(20_000 * 9.9e8)
    odd = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    assert math.isnan(odd.agg(exact_sum("x")).first()[0])
    none = spark.createDataFrame([(None,)], "x double")
    assert none.agg(exact_sum("x"), exact_avg("x")).first() == (None, None)


def test_bad_cells_do_not_end_a_run(spark):
    cells = ["NaN", "Infinity", "-Infinity", "1e14", "1e-7", "2.5"]
    rows = [{0: str(i), 1: "20240105", 29: "4", 30: c, 50: "A, X", 51: "fr", 53: c} for i, c in enumerate(cells)]
    ref = spark.createDataFrame([("FR", "0.5", "1.0000000001", "2024-01-01")], REFERENCE)
    out = gold(silver(raw_rows(spark, rows), ref, "2024-01-06", "t")).collect()
    assert len(out) == 1 and out[0].CNT_EVENTS == 6 and out[0].NUM_RISK_SCORE == 100.0
    assert out[0].NUM_GOLDSTEIN_AVG == pytest.approx((1e14 + 1e-7 + 2.5) / 3)


# --- modes and contracts --------------------------------------------------------
def test_appended_runs_count_their_own_rows(spark, sf_small):
    root = new_work_dir(spark, "append")
    FX.land_fixture(spark, sf_small, root)
    cfg = P.RunConfig.under(root, ingestion_ts=K.RUN_TS, ingestion_dates=["2024-01-05"], mode_silver="append", mode_gold="append")
    once = P.run(spark, cfg).agg(F.sum("CNT_EVENTS")).first()[0]
    assert P.run(spark, cfg).agg(F.sum("CNT_EVENTS")).first()[0] == 2 * once
    assert P.read_silver(spark, cfg).count() == 2 * once


def test_a_broken_contract_stops_the_write(spark, sf_small, monkeypatch):
    root = new_work_dir(spark, "contract")
    FX.land_fixture(spark, sf_small, root)
    cfg = P.RunConfig.under(root, ingestion_ts=K.RUN_TS, ingestion_dates=["2024-01-05"])
    before = sorted(map(tuple, P.run(spark, cfg).collect()))
    # the mart a faulty aggregate would stage: a null CNT_EVENTS
    real = P.gold
    monkeypatch.setattr(P, "gold", lambda s: real(s).withColumn(
        "CNT_EVENTS", F.when(F.col("CNT_EVENTS") < 0, F.col("CNT_EVENTS"))))
    with pytest.raises(Q.ContractError, match="CNT_EVENTS_not_null"):
        P.run(spark, cfg)
    silver_rows = P.read_silver(spark, cfg).count()
    assert sorted(map(tuple, SRC.read_gold(spark, cfg.gold).collect())) == before and silver_rows > 0


# --- Bronze, named files, arrivals ---------------------------------------------------
def test_bronze_is_as_delivered_with_utc_metadata(spark, tmp_path):
    day = tmp_path / "landing" / "events" / "ingestion_date=2024-01-05"
    day.mkdir(parents=True)
    line = ["7", "20240104"] + [""] * 56
    line[50], line[51] = "  Paris , F ", "fr"
    (day / "delivered.csv").write_text("\t".join(line) + "\n")
    ref = tmp_path / "landing" / "country_risk" / "ingestion_date=2024-01-05"
    ref.mkdir(parents=True)
    (ref / "r.csv").write_text("country,baseline_risk,risk_multiplier,updated_at\nFR,0.5,1.5,2024-01-01\n")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        cfg = P.RunConfig.under(str(tmp_path))
        P.bronze(spark, cfg)
        meta = P.read_bronze_metadata(spark, cfg).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert SRC.read_bronze_events(spark, cfg.bronze_events, cfg.runs).first()["_c50"] == "  Paris , F "
    assert [(m.source_file, m.source_system, m.rows) for m in meta] == [("delivered.csv", "gdelt", 1)]
    assert abs(time.time() - time.mktime(time.strptime(meta[0].ingestion_ts, "%Y-%m-%dT%H:%M:%SZ")) + time.timezone) < 3600


def test_cli_runs_one_file_with_a_chosen_reference(spark, sf_small):
    root = new_work_dir(spark, "cli-file")
    FX.land_fixture(spark, sf_small, root)
    old = f"{root}/landing/country_risk/ingestion_date={FX.OLD_REFERENCE_INGESTION_DATE}"
    one = f"{root}/landing/events/ingestion_date=2024-01-05/events-20240105-0.csv"
    out = cli.main(["--root", root, "--ingestion-ts", K.RUN_TS, "--events-file", one, "--reference-file", old], spark=spark)
    assert {str(r.DTE_INGESTION) for r in out.collect()} == {"2024-01-05"}
    used = P.read_silver(spark, P.RunConfig.under(root)).where("updated_at IS NOT NULL").select("updated_at").distinct().collect()
    assert [r[0] for r in used] == [FX.OLD_REFERENCE_UPDATED_AT]
    with pytest.raises(ValueError):
        cli.main(["--root", root, "--events-file", "loose.csv"], spark=spark)


def test_arrival_runs_only_new_days(spark, sf_small, monkeypatch):
    root = new_work_dir(spark, "arrive")
    FX.land_fixture(spark, sf_small, root)
    cfg = P.RunConfig.under(root, ingestion_ts=K.RUN_TS)
    days = []
    real = arrival.run
    monkeypatch.setattr(arrival, "run", lambda s, c: days.append(c.ingestion_dates) or real(s, c))
    first = arrival.run_arrived(spark, cfg, f"{root}/_seen").count()
    assert arrival.run_arrived(spark, cfg, f"{root}/_seen").count() == first and len(days) == 1
    FX.land_redelivery(spark, sf_small, root, "2024-01-16", "2024-02-20")
    assert arrival.run_arrived(spark, cfg, f"{root}/_seen").count() > first
    assert days[1] == ["2024-01-16", "2024-02-20"]


def test_folders_that_are_no_date_are_left_out(spark, tmp_path):
    line = "\t".join(["1", "20240104"] + [""] * 49 + ["fr"] + [""] * 6) + "\n"
    for folder in ("garbage", "2024-02-30", "2024-1-5", "2024-01-05"):
        (tmp_path / f"ingestion_date={folder}").mkdir()
        (tmp_path / f"ingestion_date={folder}" / "e.csv").write_text(line)
    assert [r.ingestion_date for r in SRC.read_events(spark, str(tmp_path)).collect()] == ["2024-01-05"]
    out = new_work_dir(spark, "dates")
    ST.run_available(spark, str(tmp_path), f"{out}/o", f"{out}/c", "t")
    assert ST.read_stream_output(spark, f"{out}/o", ST.PREPARED).count() == 1


# --- streams -----------------------------------------------------------------------
@pytest.mark.parametrize("newest_first", [False, True])
def test_stream_loses_no_row_in_any_order_of_arrival(spark, sf_small, newest_first):
    root = new_work_dir(spark, "order")
    feed = FX.event_feed(spark, sf_small, with_ingest_day=True)
    landed = feed.withColumn("ingestion_date", F.date_format("ingest_day", "yyyy-MM-dd")).drop("ingest_day")
    # written by several tasks: several files a day
    W.write_events_tsv(landed.repartition(3), f"{root}/landing/events", partition_by="ingestion_date")
    base = local(f"{root}/landing/events")
    days = sorted(os.listdir(base), reverse=newest_first)
    for k, day in enumerate(d for d in days if d.startswith("ingestion_date=")):
        for name in os.listdir(f"{base}/{day}"):
            os.utime(f"{base}/{day}/{name}", (1_700_000_000 + 60 * k,) * 2)
    ST.run_available(spark, f"{root}/landing/events", f"{root}/out", f"{root}/ckpt", "t", max_files_per_trigger=24)
    from riskmart.operators.silver import dedup_events, prepare
    batch = dedup_events(prepare(SRC.read_events(spark, f"{root}/landing/events"), None, "t"))
    streamed = ST.read_stream_output(spark, f"{root}/out", ST.PREPARED)
    key = lambda df: sorted(map(tuple, df.select("ingestion_date", "globaleventid", "event_date").collect()))
    assert key(streamed) == key(batch)


def _line(event, day="20240104", city="A"):
    cells = [str(event), day] + [""] * 56
    cells[50], cells[51] = city, "fr"
    return "\t".join(cells) + "\n"


def test_a_copy_is_dropped_however_late_it_comes(spark, tmp_path, monkeypatch):
    """Nothing in the stream depends on the time of the run: no watermark, no state, the stored keys decide."""
    day = tmp_path / "in" / "ingestion_date=2024-01-05"
    day.mkdir(parents=True)
    (day / "a.csv").write_text(_line(1) + _line(2) + _line(2, city="B"))
    out, ckpt = new_work_dir(spark, "late"), new_work_dir(spark, "late-ckpt")
    ST.run_available(spark, str(tmp_path / "in"), out, ckpt, "first")
    assert not fs.exists(spark, f"{ckpt}/state")
    years = time.time() + 5 * 365 * 86400
    monkeypatch.setattr(time, "time", lambda: years)
    (day / "b.csv").write_text(_line(1, city="C") + _line(3, city="C"))
    os.utime(day / "b.csv", (years, years))              # landed years after
    other = tmp_path / "in" / "ingestion_date=2024-01-06"
    other.mkdir()
    (other / "c.csv").write_text(_line(1, city="D"))     # another ingestion: kept
    ST.run_available(spark, str(tmp_path / "in"), out, ckpt, "second")
    rows = sorted((r.ingestion_date, r.globaleventid, r.city, r.ingestion_ts) for r in ST.read_stream_output(spark, out, ST.PREPARED).collect())
    assert rows == [("2024-01-05", 1, "A", "first"), ("2024-01-05", 2, "A", "first"), ("2024-01-05", 3, "C", "second"),
                    ("2024-01-06", 1, "D", "second")]


def test_a_repeated_micro_batch_stores_the_same_rows(spark, tmp_path):
    """A crash after the write and before the checkpoint: Spark hands over the batch once more."""
    from riskmart.operators.silver import prepare
    day = tmp_path / "ingestion_date=2024-01-05"
    day.mkdir()
    (day / "a.csv").write_text(_line(1) + _line(2))
    (day / "b.csv").write_text(_line(2, city="Z") + _line(4))
    first, second = (prepare(SRC.read_events(spark, f"{tmp_path}").where(f"_metadata.file_name = '{n}.csv'"), None, "t") for n in "ab")
    out = new_work_dir(spark, "again")
    for frame, batch in ((first, "q-0"), (first, "q-0"), (second, "q-1"), (second, "q-1"), (second, "q-1")):
        ST.add_batch(frame, out, batch)
    rows = sorted((r.globaleventid, r.city) for r in ST.read_stream_output(spark, out, ST.PREPARED).collect())
    assert rows == [(1, "A"), (2, "A"), (4, "A")]


def test_stored_keys_read_the_days_of_the_batch_only(spark, tmp_path):
    from riskmart.operators.silver import prepare
    for d in ("2024-01-05", "2024-01-06", "2024-01-07"):
        (tmp_path / f"ingestion_date={d}").mkdir()
        (tmp_path / f"ingestion_date={d}" / "a.csv").write_text(_line(1))
    out = new_work_dir(spark, "pruned")
    ST.add_batch(prepare(SRC.read_events(spark, str(tmp_path)), None, "t"), out, "q-0")
    keys = ST.stored_keys(spark, out, ["2024-01-06", "2024-02-01"], "q-1")
    assert [tuple(r) for r in keys.collect()] == [("2024-01-06", 1)]
    assert all("ingestion_date=2024-01-06" in f for f in keys.inputFiles())
    assert "ReadSchema: struct<globaleventid:bigint>" in keys._jdf.queryExecution().toString()


def test_arrivals_are_noticed_without_opening_files(spark, tmp_path):
    (tmp_path / "ingestion_date=2024-01-05").mkdir()
    (tmp_path / "ingestion_date=2024-01-05" / "a.csv").write_text(_line(1))
    files = ST.landed_files(spark, str(tmp_path))
    query = files.writeStream.format("memory").queryName("arrivals").trigger(availableNow=True).start()
    query.awaitTermination()
    plan = query._jsq.explainInternal(False) or ""
    assert spark.table("arrivals").count() == 1
    assert "binaryFile" in plan and "content" not in plan.split("ReadSchema:")[1].split("\n")[0] and "csv" not in plan.lower().replace("a.csv", "")


def test_workers_elsewhere_can_import_the_package(tmp_path):
    """A session started in another folder, without the package on the workers' path."""
    import subprocess
    import sys
    from pathlib import Path
    root = Path(__file__).resolve().parents[1]
    code = f"""
import sys; sys.path.insert(0, {str(root)!r})
from riskmart.session import build_session, ship_package
from riskmart.functions.columns import check_ingestion_date
spark = build_session(master="local[1]", shuffle_partitions=1)
ship_package(spark)
print("DAY", spark.sparkContext.parallelize(["2024-01-05"]).map(check_ingestion_date).collect())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "DAY ['2024-01-05']" in done.stdout, done.stderr[-2000:]


def test_null_counts_ride_on_the_run(spark, sf_small):
    """AGG-16/18 observed while Bronze is copied and Gold checked: the same numbers as a scan of their own."""
    from riskmart import schemas as S
    from riskmart.operators.analysis import null_counts
    root = new_work_dir(spark, "observed")
    paths = FX.land_fixture(spark, sf_small, root)
    cfg = P.RunConfig.under(root, ingestion_ts=K.RUN_TS).with_profile()
    mart = P.run(spark, cfg)
    got = sorted(tuple(r)[:4] for r in P.read_profile(spark, cfg).select("dataset", "column_name", "null_count", "total_rows").collect())
    events = SRC.read_events(spark, paths["events"]).select(*S.POSITIONAL_NAMES).toDF(*S.EVENT_COLUMN_NAMES)
    frames = [(events, "events"), (SRC.latest_reference(spark, paths["reference"]), "country_risk"), (mart, "gold")]
    assert got == sorted(tuple(r) for df, name in frames for r in null_counts(df, name).collect())
    order = [(-r.null_count, r.column_name) for r in null_counts(mart, "gold").collect()]
    assert order == sorted(order)
    P.run(spark, replace(cfg, ingestion_ts="later"))
    assert {r[0] for r in P.read_profile(spark, cfg).select("ingestion_ts").distinct().collect()} == {"later"}


def test_new_keys_against_the_stored_history(spark):
    from collections import Counter
    from riskmart.sinks import writers as W
    schema = "ingestion_date string, event_date string, globaleventid long"
    history = [("2024-01-0%d" % (1 + i % 3), "2024-01-01", i) for i in range(0, 3000, 7)]
    new = [("2024-01-09", "2024-01-01", i) for i in [*range(1000, 1100), 1001, 1001, 99_999]]
    out = new_work_dir(spark, "keys") + "/t"
    W.write_silver(spark.createDataFrame(history, schema), out)
    from riskmart.sinks import register as REG
    others = spark.read.schema(schema).option("basePath", out).parquet(*REG.folders(spark, REG.default_register(out), "silver", out, "ingestion_date"))
    got = Q.new_key_check(spark.createDataFrame(new, schema), others, "globaleventid", "s")
    n, held = Counter(r[2] for r in new), {r[2] for r in history}
    dup = {k for k, c in n.items() if c > 1 or k in held}
    assert tuple(got.first()) == ("s", len(new), len(n), len(dup), sum(c if k in held else c - 1 for k, c in n.items()))
    from test_plans import plan as explained
    plan = explained(got, "formatted")
    assert "PushedFilters: [IsNotNull(globaleventid), GreaterThanOrEqual(globaleventid,1000), LessThanOrEqual(globaleventid,99999)]" in plan
    assert "ReadSchema: struct<globaleventid:bigint>" in plan
    empty = spark.createDataFrame([], schema)
    assert tuple(Q.new_key_check(empty, others, "globaleventid", "s").first()) == ("s", 0, 0, 0, 0)
