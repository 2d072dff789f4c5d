"""The whole chain from raw CSV files to the model report, through the command line."""

import glob

import pytest

from tarmac.__main__ import main
from tarmac.plans import features as feature_plans
from tarmac.plans import leaderboards as leaderboard_plans
from tarmac.plans.features import build_features
from tarmac.sources.sinks import write_csv
from tests.conftest import rows


@pytest.fixture(scope="module")
def many(spark, flights):
    """Each flight a hundred times: the same averages, enough rows for a tree."""
    return flights.crossJoin(spark.range(100)).drop("id")


@pytest.fixture
def raw(tmp_path, many, airlines, airports):
    for name, table in (("flights", many), ("airlines", airlines), ("airports", airports)):
        write_csv(table, str(tmp_path / "raw" / f"{name}.csv"), header=True)
    return str(tmp_path / "raw")


def _text(folder):
    found = []
    for part in sorted(glob.glob(f"{folder}/part-*")):
        with open(part) as lines:
            found.extend(lines.read().splitlines())
    return found


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_chain(spark, capsys, tmp_path, raw, many, airlines, airports, file_format):
    clean, out = str(tmp_path / "clean"), str(tmp_path / "out")
    options = ["--format", file_format]
    main(["preprocess", raw, clean, "--flight-files", "2", *options])
    assert len(glob.glob(f"{clean}/flights/part-*")) <= 2
    main(["airlines", clean, out, "--files", "1", "--show", *options])
    shown = capsys.readouterr().out
    assert shown.index("American") < shown.index("Blue, Inc.") < shown.index("Coastal")
    main(["airports", clean, out, *options])
    assert _text(f"{out}/airlines") == ["American,5.0", '"Blue, Inc.",1.5', "Coastal,-1.0"]
    assert _text(f"{out}/airports") == [
        "Charlie,Evening,30.0",
        "Alpha Field,Morning,18.0",
        "Alpha Field,Night,12.0",
        '"Bravo, Intl",Afternoon,12.0',
        '"Bravo, Intl",Evening,8.0',
    ]
    main(["features", raw, out, f"{out}/features", *options])
    table = feature_plans.read_features(spark, f"{out}/features", file_format)
    assert rows(table) == rows(build_features(many, airlines, airports))
    main(["sample", f"{out}/features", f"{out}/sample", "--seed", "5", *options])
    main(["sample", f"{out}/features", f"{out}/content", *options])
    for name in ("sample", "content"):
        sample = feature_plans.read_features(spark, f"{out}/{name}", file_format)
        assert set(rows(sample)) <= set(rows(table))
    main(["train", f"{out}/features", f"{out}/models", "tree", "--random-split", *options])
    report = _text(f"{out}/models/tree/model-evaluation")
    assert report[1].startswith("Accuracy (Train): ")
    assert _text(f"{out}/models/tree/tree-model")[0].startswith("DecisionTree")


def test_statistics_are_read_back_typed(spark, tmp_path, raw):
    clean, out = str(tmp_path / "clean"), str(tmp_path / "out")
    main(["preprocess", raw, clean])
    main(["airlines", clean, out])
    main(["airports", clean, out])
    airline_statistic, airport_statistic = leaderboard_plans.read_statistics(spark, out)
    assert ("Blue, Inc.", 1.5) in rows(airline_statistic)
    assert ("Bravo, Intl", "Evening", 8.0) in rows(airport_statistic)


def test_unknown_job():
    with pytest.raises(SystemExit):
        main(["forecast"])
