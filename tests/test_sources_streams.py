"""Stored forms and streams."""

import datetime as dt
import random

from pyspark.sql import functions as F

from funnelloom.operators import events, targets
from funnelloom.session import scratch_path
from funnelloom.sources.readers import load_result_rows
from funnelloom.sources.target_sheet import read_sheet_csv
from funnelloom.sources.writers import nested_by_day, ordered_json, round_trip_json
from funnelloom.streaming import hourly
from funnelloom.streaming.runs import MergedRuns


def test_sheet_is_read_in_file_order(spark, tmp_path):
    pad = "," * 55
    lines = [
        "Metas Semanales,,,,,,," + pad,
        '1,2026,04/05/2026,,10/05/2026,,,"1.100",950,"1.000",-' + "," * 52,
        "nota,,,,,,," + pad,
        "Metas Diarias,,,,,,," + pad,
        '2,2026,11/05/2026,,17/05/2026,,,"9.999",9,"9.999",-' + "," * 52,
    ]
    path = tmp_path / "sheet.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    sheet = read_sheet_csv(spark, str(path), "CO")
    total = targets.targets_from_sheet(sheet).where("source = 'TOTAL'").collect()
    assert [(r.section, str(r["from"]), r.meta, r.prev) for r in total] == [("weekly", "2026-05-04", 1100, None)]
    goals = targets.weekly_targets(sheet).where("source = 'TOTAL'").collect()
    assert [(str(r.week), r.meta) for r in goals] == [("2026-05-04", 1100)]


def test_text_numbers_are_cast_and_missing_ones_stay_null(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text('{"f":"WEB","n":"12","s":"12.9"}\n{"f":"CRM","n":"0"}\n', encoding="utf-8")
    rows = load_result_rows(spark, str(path), "f string, n long, s long").orderBy("f").collect()
    assert [tuple(r) for r in rows] == [("CRM", 0, None), ("WEB", 12, 12)]


def test_documents_keep_null_spend(spark):
    daily = spark.createDataFrame(
        [("CO", dt.date(2026, 5, 1), "b", 1, 0, None), ("CO", dt.date(2026, 5, 1), "a", 2, 1, 5)],
        "country string, dia date, channel string, reg long, cal long, spend long",
    )
    stored = round_trip_json(nested_by_day(daily))
    text = stored.select(ordered_json("by_channel").alias("x")).first().x
    assert text == '{"a":{"reg":2,"cal":1,"spend":5},"b":{"reg":1,"cal":0,"spend":null}}'


class _Session:
    """The one thing ``scratch_path`` asks of a session; the setting is fixed at start."""

    def __init__(self, folder):
        self.conf = {"spark.sql.warehouse.dir": "s3a://store/warehouse"}
        if folder:
            self.conf["spark.checkpoint.dir"] = folder


def test_scratch_folder_follows_the_session():
    assert scratch_path(_Session("hdfs://shared/c/"), "x").startswith("hdfs://shared/c/x-")
    unset = scratch_path(_Session(None), "x")
    assert unset.startswith("s3a://store/warehouse/scratch/x-")
    assert unset != scratch_path(_Session(None), "x")


def _files(spark, folder, rows, schema):
    """One file per row group, in order."""
    for i, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{folder}/in/f{i}")
    return (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", "1")
        .parquet(f"{folder}/in")
    )


def _at(d, h, m=0):
    return dt.datetime(2026, 5, d, h, m)


def test_stream_counts_over_several_batches_equal_batch(spark, tmp_path):
    parts = [
        [("CO", 1, _at(20, 15), 3), ("CO", 2, _at(20, 15, 30), 3), ("CO", 1, _at(20, 15, 40), 3)],
        [("CO", 3, _at(20, 15, 50), 3), ("MX", 4, _at(20, 16, 5), 46), ("CO", 2, _at(20, 15, 1), 3)],
        [("CO", 5, _at(20, 16, 10), 3), ("MX", None, _at(20, 16, 20), 46), ("MX", 6, _at(20, 16, 30), 99)],
    ]
    schema = "country string, deal_id long, created_at timestamp_ntz, source_id int"
    stream = hourly.hourly_deals(_files(spark, tmp_path, parts, schema))
    out = hourly.drain_counts(stream, f"{tmp_path}/job")
    got = sorted((r.country, r.hour, r.source, r.n) for r in out.collect())
    assert got == [("CO", 11, "WEB", 3), ("CO", 12, "WEB", 1), ("MX", 11, "Propiedades", 1)]


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    """A second run reads new files only; late and unordered rows still decide."""
    schema = "country string, deal_id long, state_id int, ts timestamp_ntz"
    old = [[("CO", 1, 20, _at(9, 1)), ("CO", 2, 7, _at(1, 1))], [("CO", 1, 63, _at(8, 1)), ("CO", 2, 20, _at(2, 1))]]
    new = [("CO", 1, 20, _at(3, 1)), ("CO", 3, 63, _at(3, 2)), ("CO", None, 63, _at(3, 2)), ("CO", 2, 20, _at(7, 1))]

    def job():
        return sorted(tuple(r) for r in hourly.drain_first(hourly.qualifications(stream), f"{tmp_path}/job").collect())

    stream = _files(spark, tmp_path, old, schema)
    assert job() == [("CO", 1, _at(8, 1)), ("CO", 2, _at(2, 1))]
    spark.createDataFrame(new, schema).coalesce(1).write.parquet(f"{tmp_path}/in/f9")
    log = spark.createDataFrame([*old[0], *old[1], *new], schema)
    want = sorted(tuple(r) for r in events.first_event(log, (20, 63)).collect())
    assert job() == want
    runs = sorted(p.name for p in (tmp_path / "job" / "runs").iterdir())
    assert any(r.endswith("-2") for r in runs) and not any(r.endswith("-3") for r in runs)


def test_merged_runs_stay_small_and_right_over_fifty_batches(spark, tmp_path):
    rnd = random.Random(3)
    schema = spark.createDataFrame([], "country string, deal_id long, event_ts long").schema
    table = MergedRuns(spark, f"{tmp_path}/runs", schema, ("country", "deal_id"), {"event_ts": F.min})
    best, most = {}, 0
    for batch in range(50):
        rows = {("CO", rnd.randint(1, 60)): rnd.randint(0, 10_000) for _ in range(20)}
        df = spark.createDataFrame([(*k, v) for k, v in rows.items()], schema).coalesce(1)
        table.add(df, batch)
        if batch % 9 == 0:
            table.add(df, batch)  # the same batch after a failure
        for k, v in rows.items():
            best[k] = min(v, best.get(k, v))
        if batch % 7 == 6:
            most = max(most, table.stored_rows() / len(best))
    assert {(r.country, r.deal_id): r.event_ts for r in table.read().collect()} == best
    assert most <= 3 and len(list((tmp_path / "runs").iterdir())) < 20


def test_unfinished_run_is_not_read(spark, tmp_path):
    schema = spark.createDataFrame([], "k long, n long").schema
    table = MergedRuns(spark, f"{tmp_path}/runs", schema, ("k",), {"n": F.sum})
    assert table.read().collect() == []
    for batch, n in enumerate((10, 4, 1)):
        table.add(spark.range(n).selectExpr("id AS k", "1L AS n").coalesce(1), batch)
    before = sorted(tuple(r) for r in table.read().collect())
    broken = tmp_path / "runs" / "run-0-7"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"half")
    assert sorted(tuple(r) for r in table.read().collect()) == before
    assert dict(before)[0] == 3 and dict(before)[9] == 1


def test_whole_numbers_keep_all_digits(spark, tmp_path):
    path = tmp_path / "big.json"
    path.write_text('{"n":"9007199254740993"}\n{"n":"-7.9"}\n', encoding="utf-8")
    assert sorted(r.n for r in load_result_rows(spark, str(path), "n long").collect()) == [-7, 9007199254740993]
