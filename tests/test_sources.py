import glob
import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac import schemas
from tarmac.sources import csv_tables, sinks, stage
from tests.conftest import plan, rows

ODD = [
    ("A1", "Blue, Inc."),
    ("A2", 'The "Best" Air'),
    ("A3", None),
    ("A4", ""),
    ("A5", "  padded  "),
    ("A6", "back\\slash"),
    ("A7", '",'),
]


READ_BACK = sorted(((code, name or None) for code, name in ODD), key=repr)


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, schemas.RAW_AIRLINES)


def test_positional_csv_round_trip(spark, odd, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_csv(odd, path)
    assert rows(csv_tables.read_positional_csv(spark, path, odd.schema)) == READ_BACK


def test_header_csv_round_trip(spark, odd, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_csv(odd, path, header=True)
    assert rows(csv_tables.read_header_csv(spark, path)) == READ_BACK


def test_header_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text("X,B,A\n1,b,a\n2,,\n")
    found = csv_tables.read_header_csv(spark, str(tmp_path / "t.csv"), ["A", "B"])
    assert rows(found) == [("a", "b"), (None, None)]


def test_trimmed_records(spark, tmp_path):
    (tmp_path / "t.csv").write_text(' AA , American \nBB," Blue, Inc. "\nCC,\n')
    found = csv_tables.read_positional_csv(
        spark, str(tmp_path), schemas.CLEAN_AIRLINES, trim=True
    )
    assert rows(found) == [("AA", "American"), ("BB", "Blue, Inc."), ("CC", None)]


def test_typed_scan_fails_on_malformed_field(spark, tmp_path):
    (tmp_path / "t.csv").write_text("American,five\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_tables.read_positional_csv(
            spark, str(tmp_path), schemas.AIRLINE_STATISTIC
        ).collect()


def test_overwrite_replaces(spark, odd, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_csv(odd, path)
    sinks.write_csv(odd.limit(1), path)
    assert csv_tables.read_positional_csv(spark, path, odd.schema).count() == 1


def test_single_file_is_in_order(spark, tmp_path):
    path = str(tmp_path / "t")
    numbers = spark.range(1000).repartition(8).select(F.col("id").cast("string"))
    sinks.write_csv(numbers, path, files=1, order=[F.desc(F.col("id").cast("int"))])
    (part,) = glob.glob(f"{path}/part-*")
    with open(part) as lines:
        assert [int(line) for line in lines] == list(range(999, -1, -1))


def test_several_files_are_in_order_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_csv(spark.range(1000).repartition(8), path, order=["id"])
    found = []
    for part in sorted(glob.glob(f"{path}/part-*")):
        with open(part) as lines:
            found.extend(int(line) for line in lines)
    assert found == list(range(1000))


@pytest.mark.parametrize("compression", ["snappy", "none"])
def test_parquet_compression(spark, odd, tmp_path, compression):
    path = str(tmp_path / "t")
    sinks.write_parquet(odd, path, compression)
    assert rows(spark.read.parquet(path)) == rows(odd)
    marked = glob.glob(f"{path}/*.snappy.parquet")
    assert bool(marked) == (compression == "snappy")


def test_lines_keep_their_order(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.range(100).repartition(5).select(
        F.col("id").alias("line_no"), F.concat(F.lit("line "), F.col("id")).alias("line")
    )
    sinks.write_lines(table, path)
    (part,) = glob.glob(f"{path}/part-*")
    with open(part) as lines:
        assert lines.read().splitlines() == [f"line {i}" for i in range(100)]


def test_show_table(odd, capsys):
    sinks.show_table(odd, 2)
    assert "Blue, Inc." in capsys.readouterr().out


def test_stage_is_written_below_the_checkpoint_folder(spark, odd):
    before = _stage_folders(spark)
    kept = stage.keep(odd, "odd")
    (new,) = _stage_folders(spark) - before
    assert new.startswith("odd-")
    assert stage.own_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert rows(kept) == rows(odd) and kept.schema == odd.schema
    assert "parquet" in kept._jdf.queryExecution().executedPlan().toString().lower()


def test_tables_kept_together(odd):
    first, second = stage.keep_all(first=odd, second=odd.limit(2))
    assert rows(first) == rows(odd) and second.count() == 2


def test_a_failed_table_fails_the_stage(spark, odd):
    bad = spark.range(1).select(F.raise_error(F.lit("broken")).cast("string").alias("x"))
    with pytest.raises(Exception, match="broken"):
        stage.keep_all(good=odd, bad=bad)


class _Session:
    def __init__(self, master, folder=None):
        self.conf = {}
        self.sparkContext = self
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        stage.stage_root(_Session("yarn"))
    assert stage.stage_root(_Session("yarn", "hdfs:/shared/x/")) == "hdfs:/shared/x"
    alone = _Session("local[2]")
    assert stage.stage_root(alone) == stage.stage_root(alone) == alone.folder


def test_several_files_keep_one_order(spark, tmp_path):
    path = str(tmp_path / "ordered")
    numbers = spark.range(300).select(F.col("id").cast("string").alias("name"), "id")
    sinks.write_csv(numbers.repartition(5), path, files=3, order=[F.desc("id")])
    parts = sorted(p for p in (tmp_path / "ordered").iterdir() if p.name.startswith("part-"))
    assert len(parts) == 3
    found = [int(line.split(",")[1]) for p in parts for line in p.read_text().splitlines()]
    assert found == list(range(299, -1, -1))


def test_header_in_another_order_fails(spark, tmp_path):
    folder = tmp_path / "headers"
    folder.mkdir()
    (folder / "a.csv").write_text("code,name\n1,x\n")
    (folder / "b.csv").write_text("name,code\ny,2\n")
    with pytest.raises(Exception):
        csv_tables.read_header_csv(spark, str(folder)).collect()


def _stage_folders(spark):
    return set(os.listdir(stage.own_folder(spark).removeprefix("file:")))


def test_stages_of_a_job_are_deleted(spark, odd):
    before = _stage_folders(spark)
    with stage.job(spark):
        first, second = stage.keep_all(first=odd, second=odd)
        with stage.job(spark):
            third = stage.keep(first, "third")
        assert third.count() == second.count() == len(ODD)
        assert len(_stage_folders(spark) - before) == 1
    assert _stage_folders(spark) == before
    with pytest.raises(RuntimeError), stage.job(spark):
        stage.keep(odd, "lost")
        raise RuntimeError
    assert _stage_folders(spark) == before
    stage.keep(odd, "after")
    assert len(_stage_folders(spark) - before) == 1


SESSION = """
import sys
from tarmac.session import build_session
from tarmac.sources import stage

spark = build_session("stages", **{
    "spark.master": "local[1]", "spark.ui.enabled": "false", "spark.checkpoint.dir": sys.argv[1]
})
stage.keep(spark.range(5), "some")
with stage.job(spark):
    stage.keep(spark.range(5), "other")
print("left", stage.own_folder(spark), flush=True)
if sys.argv[2] == "killed":
    spark._jvm.java.lang.Runtime.getRuntime().halt(9)
"""


def test_nothing_is_left_of_an_ended_session(spark, conf, tmp_path):
    """A session that ends deletes its folder; that of a killed one goes when it has expired."""
    shared = stage.stage_root(spark).removeprefix("file:")
    names = {}
    for how, folder in (("ended", str(tmp_path)), ("killed", shared)):
        out = subprocess.run(
            [sys.executable, "-c", SESSION, folder, how],
            capture_output=True, text=True, timeout=120,
        ).stdout
        names[how] = out.split("left ")[1].strip().rpartition("/")[2]
    assert names["ended"] not in os.listdir(tmp_path)
    name = names["killed"]
    assert name in os.listdir(shared)
    assert name not in stage.sweep(spark)
    conf("tarmac.stage.keep.hours", "0")
    assert stage.sweep(spark) == []
    conf("tarmac.stage.keep.hours", "0.00001")
    time.sleep(0.2)
    assert stage.sweep(spark) == [name]


def test_merged_files_are_dealt_by_content(spark, odd):
    text = plan(sinks._placed(odd, 3, None))
    assert "REBALANCE" in text and "RoundRobin" not in text
    ordered = plan(sinks._placed(odd, 3, ["IATA_CODE"]))
    assert "rangepartitioning" in ordered and "REPARTITION_BY_NUM" in ordered


def test_records_bound_a_file(spark, tmp_path):
    for write in (sinks.write_csv, sinks.write_parquet):
        path = str(tmp_path / write.__name__)
        write(spark.range(100), path, files=1, records=30)
        assert len(glob.glob(f"{path}/part-*")) == 4


RAGGED = """AA,Alpha,1.5
BB,Bravo
CC
DD,"Delta, one",2.5,more,"and, more"
EE,Echo,five
FF,"Fox ""Trot""\",,
GG,Golf,
"HH, Inc.",x

II,,n/a,too,long
"""
RAGGED_SCHEMA = (
    T.StructType().add("code", "string").add("name", "string").add("value", "double")
)


def test_ragged_lines(spark, tmp_path):
    (tmp_path / "t.csv").write_text(RAGGED)
    found, aside = csv_tables.read_ragged_csv(spark, str(tmp_path), RAGGED_SCHEMA)
    assert rows(found) == sorted(
        [
            ("AA", "Alpha", 1.5), ("BB", "Bravo", None), ("CC", None, None),
            ("DD", "Delta, one", 2.5), ("FF", 'Fox "Trot"', None), ("GG", "Golf", None),
            ("HH, Inc.", "x", None),
        ],
        key=repr,
    )
    assert found.schema == RAGGED_SCHEMA
    assert {(r["line"][:2], r["fields"], r["reason"], r["kept"]) for r in aside.collect()} == {
        ("BB", 2, "short", True), ("CC", 1, "short", True), ("DD", 5, "long", True),
        ("EE", 3, "malformed", False), ("FF", 4, "long", True), ('"H', 2, "short", True),
        ("II", 5, "malformed", False),
    }


def test_ragged_lines_trimmed(spark, tmp_path):
    (tmp_path / "t.csv").write_text(' AA , Alpha , 1.5 \n BB , x\nCC, ,  \n')
    found, aside = csv_tables.read_ragged_csv(spark, str(tmp_path), RAGGED_SCHEMA, trim=True)
    assert rows(found) == [("AA", "Alpha", 1.5), ("BB", "x", None), ("CC", None, None)]
    assert [r["reason"] for r in aside.collect()] == ["short"]


def test_regular_lines_leave_nothing_aside(spark, odd, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_csv(odd, path)
    found, aside = csv_tables.read_ragged_csv(spark, path, odd.schema)
    assert rows(found) == READ_BACK and aside.isEmpty()
