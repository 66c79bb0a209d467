import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from fraudlens.functions import scoring
from fraudlens.operators import evaluate, reports


@pytest.fixture(scope="module")
def predicted(spark):
    pairs = [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 3 + [(2.0, 0.0)] * 1 + [(1.0, 3.0)]
    return spark.createDataFrame(pairs, "label double, prediction double")


def test_metrics_agree_with_the_library(predicted):
    got = evaluate.accuracy_and_f1(evaluate.per_class_metrics(predicted)).first()
    for name, ours in (("accuracy", got["accuracy"]), ("f1", got["f1"])):
        theirs = MulticlassClassificationEvaluator(
            labelCol="label", predictionCol="prediction", metricName=name
        ).evaluate(predicted)
        assert ours == pytest.approx(theirs)


def test_classes_never_predicted_or_never_true(predicted):
    rows = {r["class"]: r for r in evaluate.per_class_metrics(predicted).collect()}
    assert rows[2.0]["recall"] == 0.0 and rows[2.0]["precision"] == 0.0
    assert rows[3.0]["actual"] == 0 and rows[3.0]["f1"] == 0.0


def test_worst_classes(predicted):
    worst = evaluate.worst_classes(evaluate.per_class_metrics(predicted)).collect()
    assert [r["class"] for r in worst] == [2.0, 3.0, 1.0]


def test_confusion(predicted):
    wide = evaluate.confusion_matrix(predicted, [0.0, 1.0])
    row = wide.filter("label = 0").first()
    assert (row["0.0"], row["1.0"]) == (5, 2)
    assert evaluate.confusion_counts(predicted).agg(F.sum("count")).first()[0] == predicted.count()


def test_weights(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "p string")
    weights = {r["p"]: r["class_weight"] for r in evaluate.class_weights(df, "p").collect()}
    assert weights == {"a": 4 / 48, "b": 4 / 16}
    assert evaluate.top_class_weights(df, "p", 1).first()["p"] == "b"
    assert evaluate.with_class_weight(df, "p").agg(F.sum("class_weight")).first()[0] == pytest.approx(0.5)
    assert evaluate.class_count(df, "p").first()["classes"] == 2
    assert evaluate.top_classes(df, "p", 1).first()["p"] == "a"


def test_rows_without_a_class_have_its_weight(spark):
    df = spark.createDataFrame([("a",)] * 3 + [(None,)], "p string")
    weights = {r["p"]: r["class_weight"] for r in evaluate.with_class_weight(df, "p").collect()}
    assert weights == {"a": 4 / 48, None: 4 / 16}


def test_the_whole_matrix_adds_up(predicted):
    wide = evaluate.confusion_matrix(predicted)
    assert sum(r[c] for r in wide.collect() for c in wide.columns[1:]) == predicted.count()


def test_labels_out_of_range_are_unknown(spark):
    df = spark.createDataFrame([(0.0,), (2.0,)], "i double")
    assert [r[0] for r in df.select(scoring.decode_label("i", ["x", "y"])).collect()] == ["x", "unknown"]


def test_pattern_catalogue(spark):
    assert scoring.pattern_dimension(spark).count() == 16
    fintech = scoring.pattern_dimension(spark, "fintech")
    assert fintech.count() == 5 and fintech.filter("is_fraud").count() == 3


def test_pass_rate_and_empty_input(spark):
    df = spark.createDataFrame([(s,) for s in (10, 60, 70)], "fraud_score int")
    assert tuple(reports.filter_pass_rate(df).first()) == (3, 2, 1, 33)
    assert tuple(reports.filter_pass_rate(df.limit(0)).first()) == (0, 0, 0, 0)


def test_counters_are_observed_on_the_way(spark):
    from pyspark.sql import Observation

    seen = Observation("scores")
    df = spark.createDataFrame([(s,) for s in (10, 60, 70)], "fraud_score int")
    assert reports.observed(df, seen).count() == 3
    assert seen.get == {"total": 3, "high_risk": 2, "passed": 1}
