"""Quoted CSV over byte ranges: ranges that cut fields, numbering, staging and reconciliation."""
import csv
import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from kickstar.sources import csv_records, staging
from tests.conftest import rows

COLUMNS = ("a", "b", "c")


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few bytes, so that every file has many and fields span several."""
    keys = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def write(folder, name, data, end="\n", header=COLUMNS, blanks=()):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as fh:
        w = csv.writer(fh, lineterminator=end)
        w.writerow(header)
        for i, row in enumerate(data):
            if i in blanks:
                fh.write(end)
            w.writerow(row)


def made(seed, n):
    rnd = random.Random(seed)
    texts = ["", "x", "é,\"q\"", "line\nbreak", "two\n\nbreaks\n", "\"", "\n", "a" * 90, "many\n" * 40, ",", " pad "]
    return [[str(i), rnd.choice(texts), rnd.choice(texts)] for i in range(n)]


def test_ranges_that_cut_fields(spark, small_ranges):
    root = tempfile.mkdtemp(prefix="kickstar-csv-")
    data = {"p1.csv": made(1, 120), "p2.csv": made(2, 0), "p3.csv": made(3, 77)}
    for name, part in data.items():
        write(root, name, part, blanks=(0, 5, 50))
    open(os.path.join(root, "p4.csv"), "w").close()
    lines = csv_records._lines(spark, root)
    assert lines.rdd.getNumPartitions() > 20                     # many tasks per file
    starts = csv_records.ranges(spark, root)
    assert starts.filter("odd").count() > 3                      # ranges begin inside fields
    got = rows(csv_records.csv_table(spark, root, COLUMNS).select("source_file", "source_row", *[F.coalesce(c, F.lit("")) for c in COLUMNS]))
    want, n = [], 0
    for name, part in data.items():
        for row in part:
            n += 1
            want.append((name, n, *row))
    assert got == sorted(want, key=repr)


def test_same_as_one_task_reader(spark):
    root = tempfile.mkdtemp(prefix="kickstar-csv-")
    write(root, "x.csv", made(5, 200))
    with open(os.path.join(root, "x.csv"), "a", encoding="utf-8") as fh:
        fh.write('900,"",\n901,only two\n902,a,b,surplus\n903,"last, no line end"')
    plain = (spark.read.schema(staging.text_schema(COLUMNS)).option("header", "true").option("escape", '"').option("multiLine", "true")
             .option("nullValue", csv_records.NO_NULL_TOKEN).option("emptyValue", "").csv(root))
    assert rows(staging.csv_raw_source(spark, root, COLUMNS)) == rows(plain)


def test_carriage_returns(spark, small_ranges):
    root = tempfile.mkdtemp(prefix="kickstar-csv-")
    write(root, "x.csv", [["1", "p", "q"], ["2", "two\nlines", "end"]], end="\r\n", blanks=(1,))
    assert rows(csv_records.csv_table(spark, root, COLUMNS).select("source_row", *COLUMNS)) == [(1, "1", "p", "q"), (2, "2", "two\nlines", "end")]


def test_reconcile_names_bucket_and_rows(spark):
    schema = "k string, v string"
    data = [(str(i), f"v{i}") for i in range(500)]
    source = spark.createDataFrame(data, schema)
    same = spark.createDataFrame(list(reversed(data)), schema)
    assert {r.status for r in staging.reconcile_records(source, same, ["k", "v"], ["k"]).collect()} == {"PASS"}
    assert {r.status for r in staging.reconcile_records(source, None, ["k", "v"], ["k"]).collect()} == {"FAILED"}
    harmed = [(k, "changed" if k == "7" else v) for k, v in data if k != "300"] + [("42", "v42")]
    staged = spark.createDataFrame(harmed, schema)
    bad = staging.reconcile_records(source, staged, ["k", "v"], ["k"]).filter("status = 'MISMATCH'")
    assert 1 <= bad.count() <= 3 and bad.filter("source_rows + staged_rows > 60").count() == 0
    assert rows(staging.record_differences(source, staged, ["k", "v"], ["k"]).select("k", "v", "n")) == [
        ("300", "v300", 1), ("42", "v42", -1), ("7", "changed", -1), ("7", "v7", 1)]


def test_csv_load_equals_staged_load(spark):
    """Ten tables written as CSV, with line ends and quotes in unused fields, staged and loaded:
    the same facts, dimensions and counts as from the staging tables themselves."""
    from kickstar.plans import load, staged, warehouse as WH
    from tests.conftest import SF_SMALL
    # rows that share their number have no order that a file could keep
    stg = {k: v.dropDuplicates(["source_row"]).cache() for k, v in staged.staging_from_driver(spark, SF_SMALL).items()}
    folder, one, two = (tempfile.mkdtemp(prefix="kickstar-csv-") for _ in range(3))
    files = staged.write_csv_files(spark, stg, folder)
    assert sorted(files) == sorted(staging.STAGING_COLUMNS)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 << 10))
    try:
        read = staging.stage_csv(spark, files, two, dt.datetime(2024, 7, 1), "BATCH_1")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for name, df in read.items():
        assert df.count() == stg[name].count(), name
        assert df.select("source_row").distinct().count() == df.count() == (df.agg(F.max("source_row")).first()[0] or 0), name
    window = WH.LoadWindow("1990-01-01", "2030-12-31", "RUN_A")
    batch = {k: v.withColumn("batch_id", F.lit("BATCH_1")) for k, v in stg.items()}
    a, b = load.run_load(spark, batch, one, window, "2024-07-01"), load.run_load(spark, read, two, window, "2024-07-01")
    assert a == b and a["team_match"] > 0
    for table in ("fact_team_match", "fact_player_appearance", "fact_transfer", "fact_player_valuation"):
        x, y = (spark.read.parquet(f"{r}/{table}") for r in (one, two))
        assert x.exceptAll(y).count() == y.exceptAll(x).count() == 0, table
