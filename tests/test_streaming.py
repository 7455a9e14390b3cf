"""Landing files and streams: bounded batches, several batches, late readings, snapshots."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plantwatch.operators.rules import TELEMETRY_RULES, observe_rules
from plantwatch.plans import gold, silver
from plantwatch.schemas import RAW_DDL, columns_of
from plantwatch.session import fresh_path, shared_folder
from plantwatch.sources.landing import ingest, land, land_arrays
from plantwatch.sources.tables import append_table, follow, save_table, snapshot
from plantwatch.streaming import jobs


def reading(device, time, **values):
    return {"device_id": device, "timestamp": f"{time}.000000", **values}


def device(name, status="active", **values):
    stamp = "2024-01-01T00:00:00.000000"
    return {"device_id": name, "device_type": "flow_meter", "location": "L", "facility": "F", "installation_date": stamp,
            "model": "M", "manufacturer": "X", "status": status, "last_maintenance": stamp,
            "next_scheduled_maintenance": stamp, **values}


def drop(folder, name, records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(records, indent=1))


def test_arrays_of_json_stream_in_bounded_batches(spark, tmp_path):
    landing = tmp_path / "telemetry"
    for i in range(3):
        drop(landing, f"{i}.json", [reading("D", f"2024-01-01T0{i}:00:00", temperature=1.0), reading("E", "2024-01-01T00:00:00")])
    stream = ingest(spark, str(landing), "telemetry", streaming=True, max_files=1)
    written, query = jobs.run_available_now(stream)
    assert written.count() == 6
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    assert written.select("source_file").distinct().count() == 3
    batch = ingest(spark, str(landing), "telemetry")
    assert batch.columns == columns_of(RAW_DDL["telemetry"]) + ["ingestion_time", "source_file"]
    plain = columns_of(RAW_DDL["telemetry"])
    assert batch.select(*plain).exceptAll(written.select(*plain)).count() == 0


def test_landed_lines_read_back(spark, small):
    from plantwatch.catalog.queries import entities

    e = entities(spark, small)
    path = land(e.failures, fresh_path(spark, "land"), "failures")
    back = ingest(spark, path, "failures", multi_line=False)
    names = columns_of(RAW_DDL["failures"])
    assert back.select(*names).exceptAll(e.failures.select(*names)).count() == 0
    assert back.count() == e.failures.count()


def test_landed_files_are_small(spark, small, tmp_path):
    from plantwatch.catalog.queries import entities

    e = entities(spark, small)
    land(e.telemetry, str(tmp_path / "landed"), "telemetry")
    e.telemetry.select(*columns_of(RAW_DDL["telemetry"])).write.json(str(tmp_path / "plain"))
    size = lambda name: sum(f.stat().st_size for f in (tmp_path / name).glob("part-*"))
    assert 5 * size("landed") < size("plain")


def _hours(spark, landing, devices, out, checkpoint, delay="1 hour"):
    clean = silver.telemetry_clean(ingest(spark, str(landing), "telemetry", streaming=True), ingest(spark, str(devices), "device_master"))
    stream = jobs.hourly_features_stream(silver.device_health_metrics(clean), delay)
    return jobs.run_available_now(stream, out, checkpoint)[0]


@pytest.mark.parametrize("late,expected", [("2024-01-01T01:50:00", 2), ("2024-01-01T00:30:00", 1)])
def test_hours_close_once_and_late_readings_count_within_the_delay(spark, tmp_path, late, expected):
    landing, devices = tmp_path / "t", tmp_path / "d"
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    drop(devices, "d.json", [device("D")])
    drop(landing, "1.json", [reading("D", "2024-01-01T00:10:00", temperature=1.0), reading("D", "2024-01-01T01:10:00", temperature=1.0),
                             reading("D", "2024-01-01T02:20:00", temperature=1.0)])
    _hours(spark, landing, devices, out, checkpoint)
    drop(landing, "2.json", [reading("D", late, temperature=3.0), reading("D", "2024-01-01T09:00:00", temperature=1.0)])
    result = _hours(spark, landing, devices, out, checkpoint).collect()
    hours = {str(r.hour_bucket): r.reading_count for r in result}
    assert len(hours) == len(result)  # every hour once
    assert hours["2024-01-01 01:00:00"] == expected and hours["2024-01-01 00:00:00"] == 1


def test_a_drain_closes_what_the_watermark_holds_back(spark, tmp_path):
    landing, devices = tmp_path / "t", tmp_path / "d"
    drop(devices, "d.json", [device("D")])
    drop(landing, "1.json", [reading("D", f"2024-01-01T{h:02d}:10:00", temperature=1.0) for h in range(6)]
         + [reading("D", "never", temperature=2.0), reading("D", "2024-01-01T05:40:00", temperature=3.0)])

    def health():
        return silver.device_health_metrics(silver.telemetry_clean(
            ingest(spark, str(landing), "telemetry", streaming=True), ingest(spark, str(devices), "device_master")))

    def drain():
        drop(landing, "2.json", [reading("D", "2024-01-01T09:00:00")])

    written, closed = jobs.run_and_drain(lambda: jobs.hourly_features_stream(health()), drain)
    hours = {str(r.hour_bucket)[11:13]: r.reading_count for r in written.collect()}
    # The watermark stands an hour before the last reading, 04:40; the drain's own hour stays open.
    assert closed == 4 and written.count() == 6
    assert hours == {**{f"{h:02d}": 1 for h in range(5)}, "05": 2}
    aside = jobs.timeless(health(), "timestamp")
    assert aside.count() == 1 and gold.device_features(aside).first().hour_bucket is None


def test_replaced_device_snapshot_is_seen_by_the_next_run(spark, tmp_path):
    landing, devices = tmp_path / "t", tmp_path / "d"
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = silver.telemetry_clean(ingest(spark, str(landing), "telemetry", streaming=True), ingest(spark, str(devices), "device_master"))
        return jobs.run_available_now(stream, out, checkpoint)[0]

    drop(devices, "d.json", [device("D", status="inactive")])
    drop(landing, "1.json", [reading("D", "2024-01-01T00:10:00")])
    assert run().count() == 0
    drop(devices, "d.json", [device("D", status="active", location="moved")])
    drop(landing, "2.json", [reading("D", "2024-01-01T00:20:00")])
    assert [r.location for r in run().collect()] == ["moved"]


@pytest.mark.parametrize("delay,labelled", [("1 hour", 37), ("200 hours", 56)])
def test_label_join_needs_a_delay_beyond_the_horizon(spark, tmp_path, delay, labelled):
    hours = spark.range(310).select(
        F.explode(F.array(F.lit("A"), F.lit("B"))).alias("device_id"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("hour_bucket"),
    ).withColumns({
        "device_type": F.lit("t"), "location": F.lit("l"), "reading_count": F.lit(12).cast("long"),
        **{f"avg_{c}": F.lit(1.0) for c in ("temperature", "vibration", "pressure", "power")},
        **{c: F.lit(0) for c in ("high_temperature", "high_vibration", "needs_maintenance_soon")},
        "health_score": F.lit(1.0), "days_since_maintenance": F.lit(1),
    })
    start = F.lit("2024-01-01").cast("timestamp")

    def failure(name, minutes):
        return spark.range(1).select(F.lit(name).alias("device_id"), (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))).alias("failure_timestamp"),
                                     F.lit("f").alias("failure_type"), F.lit("minor").alias("severity"))

    f_path, l_path, out, checkpoint = (str(tmp_path / n) for n in ("f", "l", "out", "cp"))
    labels = gold.failure_labels(failure("A", 200 * 60 + 30))

    def run():
        stream = jobs.ml_features_stream(
            spark.readStream.schema(hours.schema).parquet(f_path), spark.readStream.schema(labels.schema).parquet(l_path), delay
        )
        return jobs.run_available_now(stream, out, checkpoint)[0]

    hours.filter("hour_bucket < timestamp'2024-01-01' + interval 201 hours").write.parquet(f_path)
    labels.write.parquet(l_path)
    run()
    hours.filter("hour_bucket >= timestamp'2024-01-01' + interval 201 hours").write.mode("append").parquet(f_path)
    gold.failure_labels(failure("B", 250 * 60 + 30)).write.mode("append").parquet(l_path)
    assert run().filter("will_fail = 1").count() == labelled


def test_rules_are_observed_while_streaming(spark, tmp_path):
    landing = tmp_path / "t"
    drop(landing, "1.json", [reading("D", "2024-01-01T00:10:00", temperature=500.0), reading("", "2024-01-01T00:10:00")])
    stream = observe_rules(ingest(spark, str(landing), "telemetry", streaming=True), "rules", TELEMETRY_RULES)
    _, query = jobs.run_available_now(stream)
    seen = [p.observedMetrics["rules"] for p in query.recentProgress if p.numInputRows]
    assert (seen[0]["rows"], seen[0]["reasonable_temperature"], seen[0]["valid_device_id"]) == (2, 1, 1)


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    save_table(df, "demo_table", "It's a comment", {"quality": "gold"})
    append_table(df, "demo_table")
    assert snapshot(spark, "demo_table").count() == 2
    assert {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES demo_table").collect()}["quality"] == "gold"
    query = jobs.run_to_table(follow(spark, "demo_table"), "demo_copy", str(tmp_path / "cp"))
    assert query.exception() is None and snapshot(spark, "demo_copy").count() == 2


def test_micro_batches_are_bounded_and_written_once(spark, tmp_path):
    rows = spark.range(90).select(
        F.concat(F.lit("M"), F.col("id")).alias("maintenance_id"), F.lit("D").alias("device_id"),
        *[F.lit(None).cast(t).alias(c) for c, t in (f.split() for f in RAW_DDL["maintenance"].replace("\n", " ").split(",")
                                                     if f.split()[0] not in ("maintenance_id", "device_id"))])
    assert land_arrays(rows, str(tmp_path / "in"), "maintenance", multiple_of=3, rows=40) == 3
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = ingest(spark, str(tmp_path / "in"), "maintenance", streaming=True, max_files=1).drop("file")
        return jobs.run_in_batches(stream, checkpoint=checkpoint, path=out)

    written = run()
    assert written.count() == 90 == written.select("maintenance_id").distinct().count()
    assert {r.batch for r in written.select("batch").distinct().collect()} == {0, 1, 2}
    assert run().count() == 90  # nothing new: no batch


def test_declared_tables_are_made_in_order_and_resumed(spark, small, tmp_path):
    from plantwatch.catalog import queries as catalog
    from plantwatch.plans import tables

    e = catalog.entities(spark, small)
    plan = tables.declared(F.lit("2024-02-01").cast("date"), F.lit("2024-02-01").cast("timestamp"))
    order = tables.build_tables(spark, plan, e.raw(), "declared_once", str(tmp_path / "db"))
    assert all(order.index(r) < order.index(t.name) for t in plan for r in t.reads if r in order)
    before = snapshot(spark, "declared_once.telemetry_clean").inputFiles()
    tables.build_tables(spark, plan, e.raw(), "declared_once", str(tmp_path / "db"), frozenset(order[:-1]))
    assert snapshot(spark, "declared_once.telemetry_clean").inputFiles() == before
    spark.sql("DROP DATABASE declared_once CASCADE")


def test_shared_folder_is_the_configured_one(spark):
    assert fresh_path(spark, "x").startswith(shared_folder(spark)) and shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


class _Bare:
    """A session without the setting, on a given master."""

    class _Conf:
        def get(self, key, default=None):
            return default

    def __init__(self, master):
        self.conf = self._Conf()
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})()


def test_without_the_setting_only_a_local_master_gets_a_folder():
    local = _Bare("local[2]")
    assert shared_folder(local) == shared_folder(local)
    with pytest.raises(RuntimeError):
        shared_folder(_Bare("yarn"))


def test_state_lies_on_disk_and_the_first_run_needs_one_batch(spark, tmp_path):
    from datetime import datetime, timedelta

    start, folder = datetime(2024, 1, 1), f"{tmp_path}/in"
    ddl = "device_id string, t timestamp"
    spark.createDataFrame([(f"d{i % 3}", start + timedelta(hours=i)) for i in range(48)], ddl).write.parquet(folder)

    def stream():
        rows = spark.readStream.schema(ddl).parquet(folder).withWatermark("t", "1 hour")
        return rows.groupBy("device_id", F.window("t", "6 hours")).count()

    def drain():
        spark.createDataFrame([("last", start + timedelta(days=9))], ddl).write.mode("append").parquet(folder)

    before = {name: spark.conf.get(name, None) for name in (*jobs.STATE, *jobs.ONE_PASS)}
    results = []
    for settings, batches in ((None, 2), (jobs.ONE_PASS, 1)):
        seen = []

        def counted():
            seen.append({c: len(list(c.joinpath("offsets").glob("[0-9]*"))) for c in checkpoints()})
            drain()

        def checkpoints():
            return [p for p in Path(spark.conf.get("spark.checkpoint.dir"), "plantwatch").glob("on-disk-checkpoint-*")]

        known = set(checkpoints())
        written, closed = jobs.run_and_drain(stream, counted, "on-disk", settings)
        own, = set(checkpoints()) - known
        assert seen[0][own] == batches and (closed > 0) == (batches == 2)
        assert "RocksDBStateStoreProvider" in own.joinpath("offsets", "0").read_text()
        results.append(sorted((r.device_id, r.window.start, r["count"]) for r in written.collect() if r.device_id != "last"))
        spark.read.parquet(folder).filter("device_id != 'last'").write.parquet(f"{tmp_path}/in-{batches}")
        folder = f"{tmp_path}/in-{batches}"
    assert results[0] == results[1] and sum(n for *_, n in results[0]) == 48
    assert {name: spark.conf.get(name, None) for name in before} == before


def test_tables_that_do_not_wait_for_each_other_are_made_together(spark, tmp_path):
    from threading import Barrier

    from plantwatch.plans.tables import Table, build_tables

    met = Barrier(2, timeout=60)

    def both(rows):
        met.wait()
        return rows.withColumn("more", F.col("id") + 1)

    plan = (*(Table(n, ("source",), both, n, "bronze") for n in ("a", "b")),
            Table("c", ("a", "b"), lambda a, b: a.unionByName(b), "c", "silver"))
    order = build_tables(spark, plan, {"source": spark.range(5)}, "declared_together", str(tmp_path / "db"))
    assert sorted(order[:2]) == ["a", "b"] and order[2] == "c"
    assert snapshot(spark, "declared_together.c").count() == 10
    spark.sql("DROP DATABASE declared_together CASCADE")


def test_state_leaves_the_local_disk_with_its_batch(spark, tmp_path):
    sc = spark.sparkContext
    local = Path(sc._jvm.org.apache.spark.util.Utils.getLocalDir(sc._jsc.sc().conf()))
    before = set(local.glob("StateStoreId*"))
    times = spark.range(500).select(F.timestamp_seconds(1704067200 + F.col("id") * 600).alias("t"), (F.col("id") % 9).alias("v"))
    times.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(times.schema).parquet(str(tmp_path / "in")).withWatermark("t", "1 hour")
    written, query = jobs.run_available_now(stream.groupBy(F.window("t", "1 hour").alias("w")).agg(F.sum("v").alias("v")))
    assert query.lastProgress["stateOperators"] and written.count() > 50
    held = [f for folder in set(local.glob("StateStoreId*")) - before for f in folder.rglob("*") if f.is_file()]
    assert held == []


def test_the_last_reading_is_that_of_the_clean_readings(spark, small):
    from plantwatch.catalog import queries as catalog

    e = catalog.entities(spark, small)
    clean = catalog._clean(e)
    last = catalog._last_reading(e)
    assert last.t == clean.agg(F.max("timestamp")).first()[0]
    assert clean.filter((F.col("timestamp") == F.lit(last.t)) & (F.col("device_id") == last.d)).count()


def test_readings_of_a_split_stream_are_not_kept(spark, small, monkeypatch):
    from plantwatch.catalog import queries as catalog

    kept, run = [], jobs.run_in_batches
    monkeypatch.setattr(jobs, "run_in_batches", lambda *args, keep=False, **options: kept.append(keep) or run(*args, keep=keep, **options))
    rows = catalog.queries()["stream_telemetry_clean_split"](spark, small)
    assert kept == [False] and rows.count() == catalog.queries()["telemetry_clean"](spark, small).count()
