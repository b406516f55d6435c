"""Packed landing files, and units that are read without a shuffle."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from offerlake.plans import registry as R
from offerlake.schemas import LANDING_COLUMNS, LANDING_SCHEMA, RECORD_SCHEMA
from offerlake.session import checkpoint_root
from offerlake.sources import landing as L
from offerlake.streaming import ingest as S

RUN, LATER = dt.datetime(2025, 5, 1, 2, 0, 0), dt.datetime(2025, 5, 2, 2, 0, 0)
AWKWARD = ["two\nlines, \"quoted\"", "", None, "  padded ", "zażółć", "a,b\r\n"]


def listings(spark, n=40):
    """Rows whose titles are awkward to write as text."""
    rows = []
    for i in range(n):
        row = dict.fromkeys(LANDING_COLUMNS, f"value {i}")
        row |= {"job_title": AWKWARD[i % len(AWKWARD)], "job_url": f"https://x/,7f000001-0a0b-4c0d-8e0f-{i:012d}",
                "expected_technologies": "SQL, Spark", "requirements": None if i % 3 else "one | two"}
        rows.append(tuple(row[c] for c in LANDING_COLUMNS))
    return spark.createDataFrame(rows, LANDING_SCHEMA)


def files_of(folder, kind):
    return [p for p in glob.glob(f"{folder}/**/part-*", recursive=True) if f".{kind}" in p]


def values(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*LANDING_COLUMNS).collect())))


def test_packed_csv_is_found_and_read_like_plain(spark, scratch_dir):
    rows = listings(spark)
    plain = L.write_csv_snapshot(rows, scratch_dir, RUN, files=3)
    packed = L.write_csv_snapshot(rows, scratch_dir, LATER, files=3, compression="gzip")
    assert files_of(plain, "csv") and all(p.endswith(".csv") for p in files_of(plain, "csv"))
    assert files_of(packed, "csv") and all(p.endswith(".csv.gz") for p in files_of(packed, "csv"))
    units = {r.unit.rsplit("/", 1)[-1]: r.files for r in L.snapshot_candidates(spark, scratch_dir).collect()}
    assert units == {os.path.basename(plain): len(files_of(plain, "csv")), os.path.basename(packed): len(files_of(packed, "csv"))}
    assert L.latest_snapshot(spark, scratch_dir).endswith("20250502_020000.csv")
    assert values(L.read_latest_snapshot(spark, scratch_dir)) == values(L.read_landing_csv(spark, plain))


def test_packed_json_is_found_and_read_like_plain(spark, scratch_dir):
    rows = listings(spark)
    arrays = {f.name: F.split(f.name, ", ") for f in RECORD_SCHEMA.fields if f.dataType.typeName() == "array"}
    records = rows.withColumns(arrays)
    plain = L.write_json_snapshot(records, scratch_dir, RUN)
    packed = L.write_json_snapshot(records, scratch_dir, LATER, compression="gzip")
    assert files_of(packed, "json") and all(p.endswith(".json.gz") for p in files_of(packed, "json"))
    assert L.latest_snapshot(spark, scratch_dir, suffix="json").endswith("20250502_020000.json")
    assert values(L.read_landing_json(spark, packed)) == values(L.read_landing_json(spark, plain)) == values(records)


def test_stream_takes_packed_files(spark, scratch_dir):
    rows, landing, bronze = listings(spark), f"{scratch_dir}/landing", f"{scratch_dir}/bronze"
    plain = L.write_csv_snapshot(rows, landing, RUN)
    L.write_csv_snapshot(rows, landing, LATER, compression="gzip")
    S.file_arrival_ingest(spark, landing, f"{scratch_dir}/ckpt", S.bronze_batch_writer(bronze, loaded_at="2025-05-02 03:00:00"))
    assert values(spark.read.parquet(bronze)) == sorted(values(L.read_landing_csv(spark, plain)) * 2)


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_only_units_of_few_files_are_shuffled(spark, scratch_dir, compression):
    rows = listings(spark, 400)
    many = L.write_csv_snapshot(rows, f"{scratch_dir}/many", RUN, files=8, compression=compression)
    one = L.write_csv_snapshot(rows, f"{scratch_dir}/one", RUN, files=1, compression=compression)

    def shuffles(path):
        return "Rebalance" in L.read_landing_csv(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert not shuffles(many) and shuffles(one)
    assert values(L.read_landing_csv(spark, many)) == values(L.read_landing_csv(spark, one))


def landed(spark, folder):
    root = checkpoint_root(spark).removeprefix("file:")
    return sorted(glob.glob(f"{root}/offerlake/{folder}/*"), key=os.path.getmtime)[-1]


def test_fixture_lands_three_packed_units(spark, monkeypatch):
    monkeypatch.setattr(R, "derived_bronze", lambda spark, _: listings(spark))
    landing = R.write_landing_fixture(spark, "")
    units = [os.path.basename(u) for u in glob.glob(f"{landing.removeprefix('file:')}/*")]
    assert sorted(units) == ["manual_export.csv", "the_it_protocol_jobs_19980531_020000.csv", "the_it_protocol_jobs_19980601_020000.csv"]
    for unit in units:
        parts = files_of(f"{landing.removeprefix('file:')}/{unit}", "csv")
        assert parts and all(p.endswith(".csv.gz") for p in parts)
        assert spark.read.options(**L.CSV_READ_OPTIONS).csv(f"{landing}/{unit}").count() == 40


def test_json_and_flattened_sinks_land_packed(spark, monkeypatch):
    monkeypatch.setattr(R, "derived_bronze", lambda spark, _: listings(spark))
    assert R.q_json_sink(spark, "").count() == R.q_flatten_lists(spark, "").count() == 40
    json, csv = files_of(landed(spark, "landing_json"), "json"), files_of(landed(spark, "landing"), "csv")
    assert json and csv and all(p.endswith(".gz") for p in json + csv)
    assert len({p.rsplit("/", 2)[1] for p in json}) == 2
