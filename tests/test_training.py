from functools import partial

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tarmac import schemas
from tarmac.operators import encoding, joins, metrics, sampling
from tarmac.plans import training
from tarmac.sources import stage
from tests.conftest import plan, rows


@pytest.fixture(scope="module")
def features(spark):
    """6000 flights, late exactly in the evening but for a few; on time is the majority."""
    h = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int")
    slots = F.array(*[F.lit(s) for s in ("Morning", "Afternoon", "Evening", "Night")])
    slot = F.element_at(slots, h(1, 4) + 1)
    late = F.when(h(9, 50) == 0, 1 - (slot == "Evening").cast("int")).otherwise(
        (slot == "Evening").cast("int")
    )
    table = spark.range(6000).select(
        F.concat(F.lit("A"), h(2, 5)).alias("Airline"),
        slot.alias("TimeSlot"),
        (h(3, 12) + 1).alias("Month"),
        (h(4, 7) + 1).alias("DayOfWeek"),
        (h(5, 4) * 150).cast("double").alias("Distance"),
        F.lit(3).alias("OriginLatitudeArea"),
        h(6, 4).alias("OriginLongitudeArea"),
        F.concat(F.lit("S"), h(6, 4)).alias("OriginState"),
        F.lit(0).alias("DestinationLatitudeArea"),
        F.lit(3).alias("DestinationLongitudeArea"),
        F.lit("S1").alias("DestinationState"),
        F.concat(F.lit("P"), h(6, 8)).alias("OriginAirport"),
        (h(2, 5) * 2).cast("double").alias("AverageAirlineDelay"),
        late.cast("double").alias("Delay"),
        (h(6, 8) * 4).cast("double").alias("AverageTaxiOut"),
    )
    return spark.createDataFrame(table.collect(), schemas.FEATURES)


def test_tree_finds_the_planted_rule(features):
    _, evaluation = training.train_and_evaluate(features, "tree")
    found = {r["set"]: r for r in evaluation.collect()}
    assert set(found) == {"Train", "Test"}
    assert found["Test"].accuracy >= 0.9 and found["Test"].recall >= 0.85


def test_logistic_metrics_are_ratios(features):
    _, evaluation = training.train_and_evaluate(features, "logistic")
    for row in evaluation.collect():
        for metric in ("accuracy", "auc"):
            assert 0 <= row[metric] <= 1


def test_compact_tree_equals_the_tree_on_single_rows(features):
    compact_train = training.split_and_compact(features).filter("set = 'Train'")
    fitted, _ = training.train_and_evaluate(features, "tree")
    train = sampling.hash_split(features).filter("set = 'Train'")
    assert compact_train.agg(F.sum("weight")).first()[0] == train.count()
    assert compact_train.count() < train.count()
    plain = Pipeline(
        stages=[
            StringIndexer(
                inputCols=list(encoding.CATEGORIES),
                outputCols=[f"{c}Index" for c in encoding.CATEGORIES],
                handleInvalid="keep",
            ),
            encoding.label_indexer(),
            encoding.bucketizer(),
            encoding.assembler(),
            DecisionTreeClassifier(
                featuresCol="features", labelCol="DelayIndex", maxDepth=10, maxBins=322
            ),
        ]
    ).fit(train)
    strip = lambda m: m.stages[-1].toDebugString.split("\n", 1)[1]
    assert strip(fitted) == strip(plain)
    assert "in {" in strip(fitted)


def test_few_combinations_still_fill_the_bins(spark, features):
    """Rows of few kinds: the compact table alone has fewer rows than there are buckets."""
    few = features.limit(3).crossJoin(spark.range(200)).drop("id")
    compact = encoding.compact(few)
    wide = encoding.spread(compact, 322)
    assert compact.count() <= 3 and wide.count() >= 322
    assert wide.agg(F.sum("weight"), F.min("weight")).first()[0] == 600
    assert wide.columns == compact.columns
    assert encoding.spread(wide, 322) is wide
    fitted, _ = training.train_and_evaluate(few, "tree", by_content=False)
    assert fitted.stages[-1].depth >= 0


@pytest.mark.parametrize("model", training.MODELS)
def test_no_task_of_a_training_holds_all_rows(features, monkeypatch, model):
    fit, sizes = {"tree": "_tree", "logistic": "_logistic"}[model], []
    made = getattr(training, fit)

    class Watched:
        def __init__(self, *args):
            self.estimator = made(*args)

        def fit(self, train):
            parts = train.groupBy(F.spark_partition_id().alias("part"))
            agg = parts.agg(F.count("*").alias("n"), F.sum("weight").alias("weight")).collect()
            sizes.append((max(r["n"] for r in agg), sum(r["n"] for r in agg), sum(r["weight"] for r in agg)))
            return self.estimator.fit(train)

    monkeypatch.setattr(training, fit, Watched)
    _, evaluation = training.train_and_evaluate(features.coalesce(1), model)
    expected = {r["set"]: tuple(r) for r in evaluation.collect()}
    monkeypatch.setattr(encoding, "TASK_ROWS", 200)
    _, evaluation = training.train_and_evaluate(features.coalesce(1), model)
    assert {r["set"]: tuple(r) for r in evaluation.collect()} == expected
    (whole, *before), (largest, *after) = sizes
    assert before == after and largest <= 220 < whole


def test_fitted_pipeline_predicts_feature_rows(features):
    fitted, evaluation = training.train_and_evaluate(features, "tree")
    by_row = metrics.confusion_metrics(
        fitted.transform(sampling.hash_split(features)), by=["set"]
    )
    assert rows(by_row.select(*evaluation.columns)) == rows(evaluation)


def test_compact_regression_agrees_with_single_rows(features):
    fitted, _ = training.train_and_evaluate(features, "logistic")
    train = sampling.hash_split(features).filter("set = 'Train'")
    encoded = PipelineModel(fitted.stages[:-1]).transform(train)
    plain = LogisticRegression(
        featuresCol="normalized_features", labelCol="DelayIndex", maxIter=10
    ).fit(encoded)
    accuracy = lambda m, t: m.transform(t).filter("prediction = DelayIndex").count()
    assert abs(accuracy(plain, encoded) - accuracy(fitted.stages[-1], encoded)) <= train.count() / 100


def test_confusion_counts_cover_every_row(features):
    fitted, _ = training.train_and_evaluate(features, "tree")
    counts = metrics.confusion_counts(fitted.transform(features)).first()
    assert sum(counts) == 6000


def test_unseen_categories_are_predicted(features):
    fitted, _ = training.train_and_evaluate(features, "tree")
    strange = features.limit(10).withColumn("OriginAirport", F.lit("XYZ"))
    assert fitted.transform(strange).select("prediction").count() == 10


def test_more_categories_than_default_bins(features):
    many = features.withColumn(
        "OriginAirport", F.lpad((F.monotonically_increasing_id() % 900).cast("string"), 3, "0")
    )
    fitted, _ = training.train_and_evaluate(many, "tree")
    assert fitted.stages[-1].getMaxBins() > 322


def test_label_one_means_late_for_any_majority(spark):
    for share in ([0.0, 1.0, 1.0], [0.0, 0.0, 1.0]):
        table = spark.createDataFrame([(s,) for s in share], "Delay double")
        indexed = encoding.label_indexer().transform(table)
        assert indexed.filter("Delay != DelayIndex").count() == 0


def test_missing_label_fails(spark):
    table = spark.createDataFrame([(None,)], "Delay double")
    with pytest.raises(Exception):
        encoding.label_indexer().transform(table).collect()


def test_bounds_are_checked_on_the_way(features):
    low = features.withColumn("Distance", F.lit(-1.0))
    with pytest.raises(ValueError, match="Distance.*6000"):
        training.train_and_evaluate(low, "tree")
    for bad in (F.lit(None).cast("double"), F.lit(float("nan"))):
        with pytest.raises(ValueError, match="AverageTaxiOut"):
            training.split_and_compact(features.withColumn("AverageTaxiOut", bad))


def test_buckets_equal_the_bucketizer(spark):
    values = [float(v) for v in range(0, 40)] + [0.5, 4.999, 2999.0, 1e9, float("inf")]
    for column in encoding.BUCKETS:
        table = spark.createDataFrame([(v,) for v in values], f"{column} double")
        theirs = encoding.bucketizer(column).transform(table)
        assert theirs.where(F.col(f"{column}Bucketed") != encoding.bucket(column)).isEmpty()


def test_features_are_read_once(spark, features, tmp_path):
    """A counter in the plan: every row of the features passes it once in a training."""
    features.write.parquet(str(tmp_path / "features"))
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    table = spark.read.parquet(str(tmp_path / "features"))
    training.train_and_evaluate(table.mapInArrow(count, table.schema), "logistic")
    assert passed.value == 6000


def test_bucketizer_itself_also_fails(features):
    low = features.withColumn("AverageAirlineDelay", F.lit(-1.5))
    with pytest.raises(Exception):
        encoding.bucketizer().transform(low).collect()


def test_unknown_model(features):
    with pytest.raises(ValueError, match="forest"):
        training.train_and_evaluate(features, "forest")


def _labels(indexer):
    found = indexer.index.orderBy("index").collect()
    return [[r.value for r in found if r.column == c] for c in encoding.CATEGORIES]


def test_indexer_equals_spark_order(features):
    theirs = StringIndexer(
        inputCols=list(encoding.CATEGORIES), outputCols=[f"i{c}" for c in encoding.CATEGORIES]
    ).fit(features).labelsArray
    assert _labels(encoding.fit_category_indexer(features)) == [list(a) for a in theirs]
    compact = encoding.compact(features)
    weighted = encoding.fit_category_indexer(compact, "weight")
    assert _labels(weighted) == [list(a) for a in theirs]


def test_missing_and_unseen_categories_share_the_spare_index(features):
    fitted = encoding.fit_category_indexer(features)
    odd = features.limit(1).withColumns(
        {"Airline": F.lit(None).cast("string"), "OriginAirport": F.lit("none of them")}
    )
    row = fitted.transform(odd).first()
    assert row.AirlineIndex == fitted.sizes["Airline"] == 5
    assert row.OriginAirportIndex == fitted.sizes["OriginAirport"] == 8


def test_many_categories(spark, features, conf):
    """200,000 names: ranked by several tasks, joined with and without a broadcast."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    many = features.limit(1).crossJoin(spark.range(240_000, numPartitions=4)).withColumn(
        "OriginAirport", F.concat(F.lit("P"), F.col("id") % 200_000)
    ).drop("id")
    fitted = encoding.fit_category_indexer(many)
    assert fitted.sizes["OriginAirport"] == 200_000
    index = fitted.index.where(F.col("column") == "OriginAirport")
    size = fitted.sizes["OriginAirport"]
    assert index.agg(F.min("index"), F.max("index"), F.countDistinct("index")).first() == (
        0.0, size - 1.0, size,
    )
    sums = []
    for limit in (joins.BROADCAST_LIMIT, 0):
        indexed = encoding.CategoryIndexer(fitted.index, limit).transform(many)
        assert ("BroadcastHashJoin" in plan(indexed)) == bool(limit)
        sums.append(indexed.agg(F.sum("OriginAirportIndex"), F.count("*")).first())
    assert sums[0] == sums[1] and sums[0][1] == 240_000


def _predictions(spark, tp, fp, fn, tn):
    pairs = [(1.0, 1.0)] * tp + [(1.0, 0.0)] * fp + [(0.0, 1.0)] * fn + [(0.0, 0.0)] * tn
    return spark.createDataFrame(pairs, "prediction double, DelayIndex double")


def test_metrics_by_hand(spark):
    found = metrics.confusion_metrics(_predictions(spark, 30, 10, 20, 40)).first()
    assert found.accuracy == 0.7 and found.precision == 0.75 and found.recall == 0.6
    assert found.auc == pytest.approx(0.7)


@pytest.mark.parametrize(
    "counts", [(30, 10, 20, 40), (0, 5, 0, 5), (5, 0, 5, 0), (0, 0, 3, 7), (4, 6, 0, 0), (0, 0, 0, 4)]
)
def test_auc_equals_the_evaluator(spark, counts):
    predictions = _predictions(spark, *counts)
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="prediction", labelCol="DelayIndex"
    )
    ours = metrics.confusion_metrics(predictions).first().auc
    assert ours == pytest.approx(evaluator.evaluate(predictions))


def test_ratios_over_nothing_are_null(spark):
    found = metrics.confusion_metrics(_predictions(spark, 0, 0, 3, 7)).first()
    assert found.precision is None and found.recall == 0
    empty = metrics.confusion_metrics(_predictions(spark, 1, 0, 0, 0).limit(0)).first()
    assert (empty.tp, empty.accuracy, empty.auc) == (0, None, None)


def test_weighted_counts(spark):
    table = spark.createDataFrame(
        [(1.0, 1.0, 30), (1.0, 0.0, 10), (0.0, 1.0, 20), (0.0, 0.0, 40)],
        "prediction double, DelayIndex double, weight long",
    )
    assert tuple(metrics.confusion_counts(table, weight="weight").first()) == (30, 10, 20, 40)


def test_report_lines(spark):
    evaluation = spark.createDataFrame(
        [("Test", 0.5, None, 0.25, 0.5), ("Train", 0.7, 0.75, 0.6, 0.7)],
        "set string, accuracy double, precision double, recall double, auc double",
    )
    lines = [r.line for r in metrics.report_lines(evaluation).orderBy("line_no").collect()]
    assert lines == [
        "",
        "Accuracy (Train): 0.7",
        "Precision (Train): 0.75",
        "Recall (Train):  0.6",
        "Area under ROC curve (Train): 0.7",
        "",
        "Accuracy (Test): 0.5",
        "Precision (Test): NaN",
        "Recall (Test):  0.25",
        "Area under ROC curve (Test): 0.5",
    ]


def test_hash_split_ignores_layout(features):
    one = rows(sampling.hash_split(features.repartition(1)))
    assert one == rows(sampling.hash_split(features.repartition(7)))
    train = sum(r[-1] == "Train" for r in one)
    assert 0.6 < train / len(one) < 0.8


def test_samples(features):
    assert 800 < sampling.hash_sample(features).count() < 1600
    assert 1000 < sampling.bernoulli_sample(features, seed=3).count() < 1400
    drawn = sampling.random_split(features).groupBy("set").count().collect()
    assert {r["set"] for r in drawn} == {"Train", "Test"}


def test_draws_ignore_layout(features):
    for draw in (partial(sampling.bernoulli_sample, seed=4), sampling.random_split):
        one = rows(draw(features.repartition(1)))
        assert one == rows(draw(features.repartition(7, "Month")))
        assert one != rows(draw(features, seed=5))


def test_equal_rows_are_drawn_one_by_one(spark):
    columns = list(sampling.CONTENT_KEY)
    table = spark.createDataFrame([("a", "Night", 1, 1, 5.0, "s", "t", "o", 0.0)], columns)
    table = table.crossJoin(spark.range(50_000)).drop("id")
    taken = sampling.bernoulli_sample(table, seed=2).count()
    assert 9_600 < taken < 10_400
    sets = {r["set"]: r["count"] for r in sampling.random_split(table).groupBy("set").count().collect()}
    assert sets["Train"] + sets["Test"] == 50_000 and 34_500 < sets["Train"] < 35_500


def test_tree_description(spark, features):
    fitted, _ = training.train_and_evaluate(features, "tree")
    lines = training.tree_description(spark, fitted).orderBy("line_no").collect()
    assert lines[0].line.startswith("DecisionTreeClassificationModel")
    assert len(lines) <= 2 * 2 ** 11


def test_normalized_length(features):
    fitted = encoding.fit_category_indexer(features)
    stages = [fitted, encoding.bucketizer(), encoding.assembler(), encoding.normalizer()]
    from pyspark.ml.functions import vector_to_array

    lengths = PipelineModel(stages).transform(features.limit(20)).select(
        F.aggregate(vector_to_array("normalized_features"), F.lit(0.0), lambda a, x: a + x * x)
    )
    assert all(r[0] == pytest.approx(1.0) for r in lengths.collect())


def test_equal_rows_are_shared_out(spark):
    """A row that is repeated meets both sets and the sample by its share."""
    one = ["a", "Night", 1, 1, 5.0, "s", "t", "o"]
    columns = list(sampling.CONTENT_KEY)
    table = spark.createDataFrame([(*one, 0.0), (*one, 1.0)], columns).withColumn(
        "n", F.explode(F.sequence(F.lit(1), F.lit(10_003)))
    ).drop("n")
    counts = sampling.hash_split(table).groupBy("Delay", "set").count().collect()
    found = {(r["Delay"], r["set"]): r["count"] for r in counts}
    for label in (0.0, 1.0):
        assert found[label, "Train"] in (7002, 7003)
        assert found[label, "Train"] + found[label, "Test"] == 10_003
    taken = sampling.hash_sample(table).groupBy("Delay").count().collect()
    assert all(r["count"] in (2000, 2001) for r in taken)


def test_split_of_large_files_has_more_partitions(spark, features, conf, monkeypatch):
    """A session's fixed number of partitions would let one task's part grow with the table."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    few = training.split_and_compact(features)
    path = stage.new_stage_path(spark, "odd name %41")
    kept = stage.keep(features.repartition(3), "features", path=path)
    monkeypatch.setattr(stage, "PARTITION_BYTES", 2000)
    many = training.split_and_compact(kept)
    assert len(few.inputFiles()) <= 4 < len(many.inputFiles())
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    with pytest.raises(ValueError), stage.shuffle_partitions_for(features):
        raise ValueError
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
