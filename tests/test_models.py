import pytest
from helpers import by, same_rows
from pyspark.sql import functions as F

from txguard import constants as C
from txguard import fixtures as fx
from txguard.config import FraudConfig
from txguard.operators import anomaly, features
from txguard.plans import applications, models, profiles

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def profile(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("profiles") / "p")
    profiles.publish_profile(profiles.build_profile(fx.history(spark, SF)), root, 1)
    return profiles.read_profile(spark, root, 1)


@pytest.fixture(scope="module")
def rows(spark, profile):
    return applications.features_of(fx.history(spark, SF), profile)


@pytest.fixture(scope="module")
def fitted(rows):
    training, _ = models.split_holdout(rows)
    return models.train_or_fall_back(training)


def test_split_is_complete_and_repeatable(rows):
    training, holdout = models.split_holdout(rows)
    assert training.count() + holdout.count() == rows.count()
    assert 0.15 < holdout.count() / rows.count() < 0.25
    assert training.join(holdout, "trans_num", "left_semi").isEmpty()


def test_holdout_beats_the_majority(rows, fitted):
    _, holdout = models.split_holdout(rows)
    scored = models.classify(holdout, fitted.classifier)
    m = models.evaluate(scored).first()
    assert m.n == holdout.count() and m.accuracy >= (m.fp + m.tn) / m.n
    assert m.detection_rate > 0.5 and m.false_positive_rate < 0.02
    measured = models.accuracy_and_auc(scored)
    assert measured["accuracy"] == pytest.approx(m.accuracy) and measured["auc"] > 0.9
    assert scored.where("ml_fraud_score < 0 or ml_fraud_score > 1").isEmpty()
    # The confidence of the predicted class is never the smaller probability.
    assert scored.where("prediction_confidence < 0.5").isEmpty()
    sure = models.classify(holdout, fitted.classifier, "confidence")
    assert sure.where("ml_fraud_score != prediction_confidence").isEmpty()


def test_scoring_leaves_features_alone(rows, fitted):
    scored = models.score(rows, fitted)
    assert dict(scored.dtypes)["is_weekend"] == "boolean"
    assert not [c for c in scored.columns if c.startswith(models.INPUT) or "scaled" in c]
    same_rows(scored.select("trans_num", "amount_deviation"), rows.select("trans_num", "amount_deviation"))


def test_scoring_copes_with_gaps(spark, fitted):
    df = spark.createDataFrame(
        [("a", None, 1.0), ("b", True, None)], "trans_num string, is_weekend boolean, prediction double"
    ).withColumn("amt", F.lit(10).cast("decimal(9,2)"))
    scored = models.classify(df, fitted.classifier)  # most inputs absent, `prediction` taken
    assert scored.count() == 2 and scored.where("ml_fraud_score is null").isEmpty()
    near = models.detect(df.withColumn("distance", F.lit(None).cast("double")).withColumns(
        {"amount_log": F.lit(1.0), "hour": F.lit(3)}), fitted.clusters)
    assert near.where("anomaly_score is null").isEmpty()


def test_both_models_on_one_frame(rows, fitted):
    scored = models.score(rows, fitted)
    assert {"prediction", "cluster", "ml_fraud_score", "anomaly_score"} <= set(scored.columns)
    assert scored.where("anomaly_score < 0 or anomaly_score > 1").isEmpty()
    rule = scored.where((F.col("distance") > 1500) & (F.col("amt") > 500))
    assert rule.where("final_fraud_status != 'FRAUD'").isEmpty()
    literal = models.score(rows, fitted, FraudConfig(cluster_score="label"))
    assert {r[0] for r in literal.select("anomaly_score").distinct().collect()} <= {0.1, 0.5, 0.9}


def test_clusters_agree_with_the_library(spark, rows, fitted):
    """The column arithmetic assigns what the vector model assigns."""
    from pyspark.ml.clustering import KMeans

    kmeans = KMeans(k=C.CLUSTERS, seed=C.SEED, maxIter=20, featuresCol="scaled_clustering", predictionCol="theirs")
    inputs = models.with_inputs(rows, C.CLUSTER_FEATURES)
    pipe = models.scaled_pipeline(C.CLUSTER_FEATURES, "scaled_clustering", kmeans).fit(inputs)
    centres = [list(map(float, c)) for c in pipe.stages[-1].clusterCenters()]
    scale = [float(x) for x in pipe.stages[1].std]
    both = anomaly.nearest_centre(pipe.transform(inputs), centres, scale)
    assert both.where("cluster != theirs").isEmpty()


def test_zero_scale_takes_a_column_out(spark):
    df = spark.createDataFrame([(1.0, 5.0)], "a double, b double")
    r = anomaly.nearest_centre(df, [[0.0, 0.0], [1.0, 0.0]], [1.0, 0.0], ["a", "b"]).first()
    assert (r.cluster, r.centre_distance) == (1, 0.0)


def test_fallbacks(rows):
    assert models.train_or_fall_back(rows.where("false")) == models.FraudModels()
    unlabelled = rows.withColumn("is_fraud", F.lit(None).cast("decimal(9,0)"))
    assert models.train_or_fall_back(unlabelled) == models.FraudModels()
    off = FraudConfig(use_classifier=False, use_clusters=False)
    assert models.train_or_fall_back(rows, off) == models.FraudModels()
    broken = models.train_or_fall_back(
        rows.withColumn("is_fraud", F.lit(-1)), FraudConfig(use_clusters=False)
    )
    assert broken == models.FraudModels()
    scored = models.score(rows)
    assert "rule_based_fraud" in scored.columns
    assert [tuple(r) for r in scored.select("ml_fraud_score", "anomaly_score").distinct().collect()] == [(0.5, 0.5)]


def test_store_versions(spark, rows, fitted, folder):
    root = folder("models")
    models.save_models(spark, fitted, root, 1)
    models.save_models(spark, fitted, root, 2, promoted=False)
    assert models.newest_version(spark, root) == 1
    again = models.load_models(spark, root)
    assert again.clusters == fitted.clusters
    columns = ("trans_num", "ml_fraud_score", "anomaly_score", "final_fraud_status")
    same_rows(models.score(rows, again).select(*columns), models.score(rows, fitted).select(*columns))
    assert models.load_models(spark, root, 2).clusters == fitted.clusters


def test_models_score_a_stream(spark, profile, fitted, folder):
    from txguard.streaming import runner

    stream = applications.score_batch(fx.arrival_stream(spark, SF), profile, fitted)
    assert stream.isStreaming
    runner.start_copy(
        stream.select("trans_num", "ml_fraud_score", "final_fraud_status"), folder("o"), "ml_stream",
        folder("cp"), trigger=None,
    ).awaitTermination()
    want = applications.score_batch(fx.arrivals(spark, SF), profile, fitted)
    same_rows(spark.read.parquet(folder("o")), want.select("trans_num", "ml_fraud_score", "final_fraud_status"))


def test_arms_are_stable_and_scored_once(rows, fitted):
    armed = models.with_arm(rows, 30)
    assert armed.groupBy("cc_num").agg(F.countDistinct("arm").alias("n")).where("n > 1").isEmpty()
    scored = models.score_by_arm(
        rows, lambda d: models.score(d, fitted).select("trans_num", "arm", "final_fraud_status"),
        lambda d: models.score(d).select("trans_num", "arm", "final_fraud_status"), 30,
    )
    assert scored.count() == rows.count() == scored.select("trans_num").distinct().count()


def test_retraining_promotes_exactly_one(rows, fitted):
    candidate, compared = models.retrain(rows, fitted.classifier, days=14)
    verdict = by(compared, "model", "promoted", "n")
    assert sorted(verdict) == ["candidate", "current"]
    assert verdict["candidate"][0] != verdict["current"][0]
    assert verdict["candidate"][1] == verdict["current"][1]


def test_training_and_serving_features_agree(spark, profile, rows):
    tx = fx.history(spark, SF)
    from_record = applications.features_of(tx.drop("event_time"), profile)
    columns = ["trans_num", *C.CLASSIFIER_FEATURES]
    same_rows(rows.select(columns), from_record.select(columns))
    assert set(features.model_inputs(rows).columns) == set(rows.columns)


def test_models_follow_the_rows_only(spark, rows, fitted):
    """However the rows are partitioned and ordered, training gives the same model."""
    training, holdout = models.split_holdout(rows)
    again = models.train_or_fall_back(training.repartition(5).sortWithinPartitions(F.desc("trans_num")))
    for a, b in zip(fitted.clusters.centres, again.clusters.centres):
        assert a == pytest.approx(b, abs=1e-9)
    score = lambda m: holdout.transform(models.classify, m.classifier).agg(F.sum("ml_fraud_score")).first()[0]
    assert score(fitted) == pytest.approx(score(again), abs=1e-6)


def test_parts_are_stored_as_they_are(spark, fitted, folder):
    root = folder("parts")
    models.save_models(spark, models.FraudModels(None, fitted.clusters), root, 1)
    found = models.load_models(spark, root)
    assert found.classifier is None and found.clusters == fitted.clusters
    models.save_models(spark, models.FraudModels(fitted.classifier, None), root, 2)
    found = models.load_models(spark, root)
    assert found.classifier is not None and found.clusters is None


def test_failures_of_training_are_raised(rows, monkeypatch):
    def broken(table):
        raise OSError("no space left")

    monkeypatch.setattr(models, "fit_clusters", broken)
    with pytest.raises(OSError, match="no space"):
        models.train_or_fall_back(rows, FraudConfig(use_classifier=False))


def test_training_partitions_grow_with_the_rows(spark):
    """What a task keeps of a training table is bounded well before a million rows; small tables keep their layout."""
    assert models.laid_out(spark.range(900_001).select(F.col("id").alias("trans_num"))).rdd.getNumPartitions() == 10
    assert models.laid_out(spark.range(700_000).select(F.col("id").alias("trans_num"))).rdd.getNumPartitions() == 8
