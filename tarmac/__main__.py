"""Command line: one sub-command per job, for spark-submit."""

import argparse

from tarmac.operators.summary import print_overview
from tarmac.plans.features import read_features, run_feature_job, run_sampling
from tarmac.plans.leaderboards import run_airline_leaderboard, run_airport_leaderboard
from tarmac.plans.preprocessing import run_preprocessing
from tarmac.plans.training import MODELS, run_training
from tarmac.session import build_session


def _parser():
    parser = argparse.ArgumentParser(prog="tarmac", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name, *paths):
        sub = jobs.add_parser(name)
        for path in paths:
            sub.add_argument(path)
        sub.add_argument("--format", choices=("parquet", "csv"), default="parquet")
        return sub

    job("preprocess", "raw", "clean").add_argument("--flight-files", type=int)
    for name in ("airlines", "airports"):
        board = job(name, "clean", "output")
        board.add_argument("--files", type=int)
        board.add_argument("--show", action="store_true")
    features = job("features", "raw", "statistics", "output")
    features.add_argument("--overview", action="store_true")
    sample = job("sample", "features", "output")
    sample.add_argument("--seed", type=int)
    sample.add_argument("--random", action="store_true")
    sample.add_argument("--files", type=int)
    train = job("train", "features", "output")
    train.add_argument("model", choices=MODELS)
    train.add_argument("--random-split", action="store_true")
    return parser


def main(arguments=None):
    a = _parser().parse_args(arguments)
    spark = build_session(f"tarmac {a.job}")
    if a.job == "preprocess":
        run_preprocessing(spark, a.raw, a.clean, a.format, a.flight_files)
    elif a.job == "airlines":
        run_airline_leaderboard(spark, a.clean, a.output, a.format, a.files, a.show)
    elif a.job == "airports":
        run_airport_leaderboard(spark, a.clean, a.output, a.format, a.files, a.show)
    elif a.job == "features":
        run_feature_job(spark, a.raw, a.statistics, a.output, a.format)
        if a.overview:
            print_overview(read_features(spark, a.output, a.format))
    elif a.job == "sample":
        run_sampling(spark, a.features, a.output, a.format, a.seed, not a.random, a.files)
    else:
        run_training(spark, a.features, a.output, a.model, a.format, not a.random_split)


if __name__ == "__main__":
    main()
