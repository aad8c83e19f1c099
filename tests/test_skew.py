"""Hot keys and fallbacks: results stay whole and deterministic."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from conftest import raw_rows
from riskmart.operators import quality as Q
from riskmart.operators import silver as SV


def _hot_feed(spark, n=3000):
    rows = []
    for i in range(n):
        hot = i % 3 == 0                     # a third of all rows share one event id
        rows.append({0: "7" if hot else str(1000 + i), 1: "20240105", 29: str(1 + i % 4),
                     30: f"{(i % 50) - 25}.5", 50: f"City {i % 5}, X", 51: ["fr", "mx", "ir"][i % 3]})
    for i in range(n // 3):                  # and a flood of rows without an id
        rows.append({0: None, 1: "20240105", 51: "fr"})
    return raw_rows(spark, rows)


def test_hot_key_dedup_keeps_the_smallest_copy(spark):
    raw = _hot_feed(spark).repartition(6)
    out = SV.dedup_events(SV.prepare(raw, "2024-01-06", "t"))
    hot = out.where(F.col("globaleventid") == 7).collect()
    assert len(hot) == 1
    # survivor = first in (event_date, quadclass, goldstein, ...) order among the copies
    copies = SV.prepare(raw, "2024-01-06", "t").where(F.col("globaleventid") == 7)
    best = copies.orderBy("quadclass", "goldstein_scale").first()
    assert (hot[0].quadclass, hot[0].goldstein_scale) == (best.quadclass, best.goldstein_scale)
    assert out.count() == 1 + 2000


def test_reject_accounting_with_null_flood(spark):
    raw = _hot_feed(spark).repartition(6)
    got = {r.outcome: r.rows for r in Q.reject_accounting(raw, "2024-01-06", "t").collect()}
    assert got == {"missing_event_id": 1000, "accepted": 2001, "duplicate": 999}


def test_reference_join_is_the_same_without_broadcast(spark):
    raw = _hot_feed(spark)
    ref = spark.createDataFrame([("FR", "0.5", "1.2", "2024-01-01"), ("MX", "0.6", "1.25", "2024-01-01")],
                                "country string, baseline_risk string, risk_multiplier string, updated_at string")
    events = SV.dedup_events(SV.prepare(raw, "2024-01-06", "t"))
    dim = SV.reference_dimension(ref)
    small = sorted(map(tuple, SV.enrich(events, dim).collect()))
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        big = SV.enrich(events, dim)
        buf = io.StringIO()
        with redirect_stdout(buf):
            big.explain()
        assert "SortMergeJoin" in buf.getvalue()
        assert sorted(map(tuple, big.collect())) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_spread_splits_a_one_unit_scan_evenly(spark, sf_small):
    from riskmart.sources.files import spread
    # the driver's events file is one Parquet row group: one scan task
    scan = spark.read.parquet(f"{sf_small}/events.parquet")
    assert scan.rdd.getNumPartitions() == 1
    # a third of the rows are identical copies: they must not share one partition
    copies = (scan.limit(1).select("*", F.explode(F.sequence(F.lit(1), F.lit(scan.count() // 2))).alias("_k"))
                  .drop("_k"))
    wide = spread(scan.unionByName(copies).coalesce(1), 4)
    sizes = [r["count"] for r in wide.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 4 and max(sizes) <= 1.2 * min(sizes)
    assert wide.exceptAll(scan.unionByName(copies)).count() == 0
    assert wide.count() == scan.count() + scan.count() // 2


def test_hot_partition_folder_is_written_by_several_tasks(spark, tmp_path):
    import os
    from riskmart.sinks import writers as W
    n = 60000
    hot = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 40 + 2)   # one date holds a third
    df = (spark.range(0, n, 1, 8)
               .select(F.lit("2024-01-06").alias("ingestion_date"),
                       F.date_add(F.lit("2024-01-01").cast("date"), hot.cast("int")).alias("event_date"),
                       F.col("id").alias("globaleventid"),
                       F.sha2(F.col("id").cast("string"), 256).alias("payload")))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    previous = spark.conf.get(key)
    try:
        spark.conf.set(key, "256k")
        W.write_silver(df, str(tmp_path / "silver"), mode="replace")
    finally:
        spark.conf.set(key, previous)
    folder = next((tmp_path / "silver").glob("run=*")) / "ingestion_date=2024-01-06" / "event_date=2024-01-02"
    files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    assert len(files) > 1
    back = spark.read.parquet(str(tmp_path / "silver"))
    assert back.count() == n and back.where(F.col("event_date") == "2024-01-02").count() == n // 3


def test_stream_dedup_with_a_hot_id_across_files_and_batches(spark, tmp_path):
    from riskmart.sinks import writers as W
    from riskmart.streaming import incremental as ST
    feed = _hot_feed(spark)                  # a third of the rows share id 7, plus a null-id flood
    landed = (feed.withColumn("ingestion_date", F.lit("2024-01-06"))
                  .unionByName(feed.withColumn("ingestion_date", F.lit("2024-01-07")))   # redelivered next day
                  .repartition(6))
    root = str(tmp_path / "landing")
    W.write_events_tsv(landed, root, partition_by="ingestion_date")
    ST.run_available(spark, root, str(tmp_path / "out"), str(tmp_path / "ckpt"), "t", max_files_per_trigger=2)   # several micro-batches
    out = ST.read_stream_output(spark, str(tmp_path / "out"), ST.PREPARED)
    # one row an ingestion day, as in a batch run
    assert out.where(F.col("globaleventid") == 7).count() == 2
    assert out.count() == out.select("ingestion_date", "globaleventid").distinct().count() == 2 * (1 + 2000)


def test_gold_hot_group_matches_brute_force(spark):
    from decimal import ROUND_HALF_UP, Decimal
    from riskmart.operators.gold import gold
    n = 3000
    rows = []
    for i in range(n):
        hot = i % 3 == 0                     # a third of all events fall in one (day, country, city) group
        rows.append({0: str(10_000 + i), 1: "20240105" if hot else f"202401{10 + i % 9:02d}",
                     29: str(1 + i % 4), 30: f"{(i % 40) - 20}.25",
                     50: "Tehran, IR" if hot else f"City {i % 6}, X", 51: "ir" if hot else ["fr", "mx"][i % 2]})
    raw = raw_rows(spark, rows).repartition(5)
    ref = spark.createDataFrame([("IR", "0.85", "1.4", "2024-01-01"), ("FR", "0.5", "1.2", "2024-01-01")],
                                "country string, baseline_risk string, risk_multiplier string, updated_at string")
    mart = gold(SV.silver(raw, ref, "2024-01-06", "t"))
    got = mart.where((F.col("NAM_COUNTRY") == "IR") & (F.col("NAM_CITY") == "Tehran")).collect()
    assert len(got) == 1
    hot_rows = [r for i, r in enumerate(rows) if i % 3 == 0]
    weights = [Decimal(str({1: 0.25, 2: 0.5, 3: 0.75, 4: 1.0}[int(r[29])])) * Decimal("1.4") for r in hot_rows]
    score = (sum(weights) / len(weights) * 100).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    gold_avg = sum(Decimal(r[30]) for r in hot_rows) / len(hot_rows)
    assert got[0].CNT_EVENTS == n // 3
    assert got[0].NUM_RISK_SCORE == float(score)
    assert abs(got[0].NUM_GOLDSTEIN_AVG - float(gold_avg)) < 1e-9
    assert mart.agg(F.sum("CNT_EVENTS")).first()[0] == n
