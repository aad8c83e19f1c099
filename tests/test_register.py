"""Runs side by side, runs cut off, modes, and what vacuum removes."""

import random

import pytest
from pyspark.sql import functions as F

from riskmart import fs
from riskmart.operators import quality as Q
from riskmart.plans import constants as K
from riskmart.plans import runs as P
from riskmart.session import new_work_dir
from riskmart.sinks import register as REG
from riskmart.sinks import writers as W
from riskmart.sources import files as SRC
from riskmart.sources import fixture as FX

DAYS = ["2024-01-05", "2024-01-06"]
STEPS = ["bronze", "silver", "gold", "shown"]


@pytest.fixture(scope="module")
def landing(spark, sf_small):
    root = new_work_dir(spark, "register-landing")
    return FX.land_fixture(spark, sf_small, root)


def config(spark, landing, tag, days, ts="t", **kw):
    cfg = P.RunConfig.under(f"{new_work_dir(spark, tag)}/t", ingestion_ts=ts, ingestion_dates=days, **kw)
    return P.replace(cfg, landing_events=landing["events"], landing_reference=landing["reference"])


def view(spark, cfg):
    """{day: (run time of its Silver rows, Silver rows, events of its Gold rows, Bronze rows, run time of its Bronze)}"""
    silver = {r[0]: (r[1], r[2]) for r in P.read_silver(spark, cfg).groupBy("ingestion_date").agg(
        F.array_sort(F.collect_set("ingestion_ts")), F.count(F.lit(1))).collect()}
    gold = {str(r[0]): r[1] for r in P.read_gold(spark, cfg).groupBy("DTE_INGESTION").agg(F.sum("CNT_EVENTS")).collect()}
    bronze = {r[0]: r[1] for r in SRC.read_bronze_events(spark, cfg.bronze_events, cfg.runs).groupBy("ingestion_date").count().collect()}
    meta = {r[0]: r[1] for r in P.read_bronze_metadata(spark, cfg).groupBy("ingestion_date").agg(
        F.array_sort(F.collect_set("ingestion_ts"))).collect()}
    assert silver.keys() == gold.keys() == bronze.keys() == meta.keys()
    return {d: (*silver[d], gold[d], bronze[d], meta[d]) for d in silver}


def advance(run, n):
    return [next(run) for _ in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_a_run_cut_off_anywhere_shows_the_old_tables(spark, landing, n):
    cfg = config(spark, landing, "cut", DAYS, "old")
    P.run(spark, cfg)
    before = view(spark, cfg)
    run = P.steps(spark, P.replace(cfg, ingestion_ts="new"))
    assert advance(run, n) == STEPS[:n]
    run.close()                                    # the driver dies here
    assert view(spark, cfg) == before and {v[0][0] for v in before.values()} == {"old"}
    P.run(spark, P.replace(cfg, ingestion_ts="newer"))
    after = view(spark, cfg)
    assert {(*v[0], *v[4]) for v in after.values()} == {("newer", "newer")}
    assert {d: v[1:4] for d, v in after.items()} == {d: v[1:4] for d, v in before.items()}


@pytest.mark.parametrize("n,same_day", [(0, False), (1, False), (2, False), (3, False), (1, True), (3, True)])
def test_two_runs_interleaved_at_every_step(spark, landing, n, same_day):
    cfg = config(spark, landing, "two", None, "a")
    a = P.steps(spark, P.replace(cfg, ingestion_dates=DAYS[:1]))
    b = P.steps(spark, P.replace(cfg, ingestion_dates=DAYS[:1] if same_day else DAYS[1:], ingestion_ts="b"))
    advance(a, n)
    assert list(b) == STEPS                        # b runs whole while a stands still
    assert list(a) == STEPS[n:]
    seen = view(spark, cfg)
    want = {DAYS[0]: "a"} if same_day else {DAYS[0]: "a", DAYS[1]: "b"}
    assert {d: v[0] for d, v in seen.items()} == {d: [ts] for d, ts in want.items()} == {d: v[4] for d, v in seen.items()}
    for rows, events in ((v[1], v[2]) for v in seen.values()):
        assert rows == events > 0


def test_a_failing_step_removes_its_rows_and_shows_nothing(spark, landing, monkeypatch):
    cfg = config(spark, landing, "fail", DAYS[:1], "old")
    P.run(spark, cfg)
    before = view(spark, cfg)
    monkeypatch.setattr(P, "gold", lambda s: (_ for _ in ()).throw(RuntimeError("no mart")))
    with pytest.raises(RuntimeError, match="no mart"):
        P.run(spark, P.replace(cfg, ingestion_ts="new"))
    assert view(spark, cfg) == before
    assert len(fs.partition_values(spark, cfg.silver, "run")) == 1


def test_a_commit_that_fails_shows_nothing(spark, landing, monkeypatch):
    cfg = config(spark, landing, "commit", DAYS[:1], "old")
    P.run(spark, cfg)
    before = view(spark, cfg)
    monkeypatch.setattr(REG.Run, "commit", lambda self: (_ for _ in ()).throw(OSError("store refused")))
    with pytest.raises(OSError):
        P.run(spark, P.replace(cfg, ingestion_ts="new"))
    assert view(spark, cfg) == before


def test_a_day_without_rows_becomes_empty(spark, landing):
    cfg = config(spark, landing, "empty", DAYS, "t")
    P.run(spark, cfg)
    empty = f"{new_work_dir(spark, 'none')}/ingestion_date={DAYS[0]}/e.csv"
    fs.write_text(spark, empty, "\n")
    P.run(spark, P.replace(cfg, ingestion_dates=None, events_file=empty), with_bronze=False)
    assert [str(r[0]) for r in P.read_gold(spark, cfg).select("DTE_INGESTION").distinct().collect()] == DAYS[1:]
    assert Q.evaluate(P.read_silver(spark, cfg, DAYS[:1]), "silver", Q.silver_rules()).where("total > 0").count() == 0


# --- modes against a model ------------------------------------------------------
SMALL = "ingestion_date string, event_date string, globaleventid long"


def small(spark, days, run):
    return spark.createDataFrame([(d, "2024-01-01", run) for d in days], SMALL)


@pytest.mark.parametrize("seed", range(4))
def test_modes_follow_the_model(spark, seed):
    rng = random.Random(seed)
    root = f"{new_work_dir(spark, 'model')}/t"
    model = {}
    for run in range(6):
        mode = rng.choice(REG.MODES)
        held = rng.sample(["2024-01-01", "2024-01-02", "2024-01-03"], rng.randint(0, 3))
        named = sorted(set(held) | set(rng.sample(["2024-01-01", "2024-01-02", "2024-01-04"], rng.randint(0, 2))))
        assert W.write_silver(small(spark, held, run), root, mode, named) == named
        if mode == "overwrite":
            model = {}
        for day in named:
            if mode != "append":
                model[day] = []
            if day in held:
                model.setdefault(day, []).append(run)
        if seed == 3 and run % 2:
            REG.vacuum(spark, REG.default_register(root), keep_hours=0)
        if fs.exists(spark, REG.default_register(root)):
            shown = {}
            for day, which in REG.shown(spark, REG.default_register(root), "silver"):
                rows = spark.read.schema(SMALL).parquet(f"{REG.run_folder(root, which)}/ingestion_date={day}")
                shown.setdefault(day, []).extend(r.globaleventid for r in rows.collect())
            assert {d: sorted(v) for d, v in shown.items()} == {d: v for d, v in model.items() if v}


def test_vacuum_removes_what_does_not_show(spark, landing):
    cfg = config(spark, landing, "vacuum", DAYS, "1")
    P.run(spark, cfg)
    P.run(spark, P.replace(cfg, ingestion_ts="2", ingestion_dates=DAYS[:1]))
    dead = P.steps(spark, P.replace(cfg, ingestion_ts="3"))
    advance(dead, 2)
    dead.close()
    before = view(spark, cfg)
    assert P.vacuum(spark, cfg) == []              # nothing is a week old
    gone = P.vacuum(spark, cfg, keep_hours=-1)     # as if an hour had passed
    assert any(DAYS[0] in path and "silver" in path for path in gone) and not any(DAYS[1] in path for path in gone)
    assert view(spark, cfg) == before
    assert len(fs.partition_values(spark, cfg.silver, "run")) == 2
    P.run(spark, P.replace(cfg, ingestion_ts="4"))
    P.vacuum(spark, cfg, keep_hours=-1)
    assert len(fs.partition_values(spark, cfg.runs, "run")) == 1 and {v[0][0] for v in view(spark, cfg).values()} == {"4"}


def test_a_country_stands_in_few_files(spark):
    """SNK-7: clustering across the files of a day, so that statistics skip files."""
    root = f"{new_work_dir(spark, 'cluster')}/gold"
    mart = spark.range(40_000).select(
        F.lit("2024-01-05").cast("date").alias("DTE_EVENT"), F.concat(F.lit("C"), F.col("id") % 97).alias("NAM_COUNTRY"),
        F.col("id").cast("string").alias("NAM_CITY"), F.lit(1).cast("long").alias("CNT_EVENTS"), F.lit(0.0).alias("NUM_GOLDSTEIN_AVG"),
        F.lit(1.0).alias("NUM_RISK_SCORE"), F.lit("2024-01-06").cast("date").alias("DTE_INGESTION"))
    W.write_gold(mart.repartition(8), root, files=8)
    stored = SRC.read_gold(spark, root)
    assert stored.count() == 40_000 and len(stored.inputFiles()) == 8
    files = spark.read.parquet(*stored.inputFiles()).select("NAM_COUNTRY", F.col("_metadata.file_name").alias("f"))
    per_country = files.groupBy("NAM_COUNTRY").agg(F.count_distinct("f").alias("n"))
    assert per_country.agg(F.max("n")).first()[0] <= 2
    assert per_country.agg(F.sum("n")).first()[0] <= 97 + 8
