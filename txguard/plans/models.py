"""Training, scoring, storing and comparing models."""

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard import constants as C
from txguard.config import FraudConfig
from txguard.functions.hashing import bucket_of
from txguard.operators import anomaly, drift, rules
from txguard.operators.features import labelled, model_inputs
from txguard.operators.metrics import classification_metrics
from txguard.plans.workspace import stored

log = logging.getLogger(__name__)

HOLDOUT_PERCENT = 20
TRAINING_PARTITIONS = 8
INPUT = "in_"


@dataclass(frozen=True)
class ClusterModel:
    """k-means reduced to numbers: scoring needs no vectors, only column arithmetic."""

    columns: tuple[str, ...]
    scale: tuple[float, ...]
    centres: tuple[tuple[float, ...], ...]
    typical: float


@dataclass(frozen=True)
class FraudModels:
    classifier: PipelineModel | None = None
    clusters: ClusterModel | None = None
    version: int | None = None  # of the store they were loaded from


def scaled_pipeline(columns, output: str, *last) -> Pipeline:
    raw = f"{output}_raw"
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=[INPUT + c for c in columns], outputCol=raw),
            StandardScaler(inputCol=raw, outputCol=output),
            *last,
        ]
    )


def with_inputs(df: DataFrame, columns) -> DataFrame:
    """Adds the model inputs under names of their own, so the features stay as they were."""
    return model_inputs(df, columns, INPUT)


def training_table(features: DataFrame, path: str | None = None) -> DataFrame:
    """Id, time, label and model inputs of feature rows, stored once for all fits and comparisons.

    Without `path` the table goes to the session's shared folder.
    """
    columns = tuple(dict.fromkeys((*C.CLASSIFIER_FEATURES, *C.CLUSTER_FEATURES)))
    time = [F.col("event_time")] if "event_time" in features.columns else []
    narrow = with_inputs(features, columns).select(
        "trans_num", *time, F.col("is_fraud").cast("double").alias("label"), "is_fraud",
        *[INPUT + c for c in columns],
    )
    if path is None:
        return stored(narrow, "training")
    narrow.write.mode("overwrite").parquet(path)
    return features.sparkSession.read.parquet(path)


def laid_out(table: DataFrame) -> DataFrame:
    """The rows of a training table in partitions and an order that follow from the rows alone.

    Bootstrap samples and the start of k-means depend on partitions and order, so a layout that followed
    files or cores would give each machine another model. Partitions hold about
    ROWS_PER_TRAINING_PARTITION rows.
    """
    n = max(TRAINING_PARTITIONS, -(-table.count() // C.ROWS_PER_TRAINING_PARTITION))
    return table.repartition(n, F.xxhash64("trans_num")).sortWithinPartitions(*table.columns)


def split_holdout(df: DataFrame, percent: int = HOLDOUT_PERCENT) -> tuple[DataFrame, DataFrame]:
    """(training, hold-out) by a hash of the transaction id: the same rows every time."""
    held = F.coalesce(bucket_of("trans_num") < percent, F.lit(False))
    return df.where(~held), df.where(held)


def fit_classifier(table: DataFrame) -> PipelineModel:
    """Random forest on scaled inputs of a training table."""
    forest = RandomForestClassifier(
        labelCol="label",
        featuresCol="scaled_features",
        numTrees=C.CLASSIFIER_TREES,
        maxDepth=C.CLASSIFIER_DEPTH,
        seed=C.SEED,
        maxMemoryInMB=1024,
    )
    inputs = [INPUT + c for c in C.CLASSIFIER_FEATURES]
    rows = laid_out(labelled(table).select("trans_num", "label", *inputs))
    return scaled_pipeline(C.CLASSIFIER_FEATURES, "scaled_features", forest).fit(rows)


def fit_clusters(table: DataFrame) -> ClusterModel:
    kmeans = KMeans(
        k=C.CLUSTERS,
        seed=C.SEED,
        maxIter=C.CLUSTER_ITERATIONS,
        featuresCol="scaled_clustering",
        predictionCol="cluster",
    )
    rows = laid_out(table.select("trans_num", *[INPUT + c for c in C.CLUSTER_FEATURES]))
    fitted = scaled_pipeline(C.CLUSTER_FEATURES, "scaled_clustering", kmeans).fit(rows)
    _, scaler, clusters = fitted.stages
    summary = clusters.summary
    return ClusterModel(
        columns=C.CLUSTER_FEATURES,
        scale=tuple(float(x) for x in scaler.std),
        centres=tuple(tuple(float(x) for x in c) for c in clusters.clusterCenters()),
        typical=(summary.trainingCost / sum(summary.clusterSizes)) ** 0.5,
    )


def train_or_fall_back(features: DataFrame, config: FraudConfig = FraudConfig()) -> FraudModels:
    """Models from labelled feature rows. Those switched off, or that cannot be learned from these rows,
    are None and scoring falls back to rules: no rows, or no two classes 0 and 1 for the classifier.
    Any other failure is raised."""
    if not (config.use_classifier or config.use_clusters):
        return FraudModels()
    table = training_table(labelled(features))
    labels = [r[0] for r in table.select("label").distinct().limit(3).collect()]
    two = sorted(x for x in labels if x is not None) == [0.0, 1.0]
    if config.use_classifier and labels and not two:
        log.warning("labels %s: no classifier, scoring falls back to rules", labels)
    return FraudModels(
        fit_classifier(table) if config.use_classifier and two else None,
        fit_clusters(table) if config.use_clusters and labels else None,
    )


def classify(df: DataFrame, model: PipelineModel, score: str = "fraud") -> DataFrame:
    """Adds `ml_fraud_score`, the probability of fraud, and `prediction_confidence`, the
    probability of whichever class is predicted; `score="confidence"` uses that as the score."""
    clash = [c for c in ("prediction", "probability", "rawPrediction") if c in df.columns]
    scored = model.transform(with_inputs(df.drop(*clash), C.CLASSIFIER_FEATURES))
    p = vector_to_array("probability")
    fraud = F.coalesce(F.get(p, F.lit(1)), F.lit(0.0))
    confidence = F.get(p, F.col("prediction").cast("int"))
    return scored.withColumns(
        {
            "ml_fraud_score": confidence if score == "confidence" else fraud,
            "prediction_confidence": confidence,
        }
    ).drop(
        *[INPUT + c for c in C.CLASSIFIER_FEATURES],
        "scaled_features_raw", "scaled_features", "rawPrediction", "probability",
    )


def detect(df: DataFrame, model: ClusterModel, score: str = "distance") -> DataFrame:
    near = anomaly.nearest_centre(df, model.centres, model.scale, model.columns)
    if score == "label":
        return anomaly.score_by_cluster(near)
    return anomaly.score_by_distance(near, model.typical)


def evaluate(scored: DataFrame) -> DataFrame:
    """One row: counts and rates of the predicted class against the label."""
    return classification_metrics(labelled(scored), "is_fraud", "prediction")


def accuracy_and_auc(scored: DataFrame) -> dict[str, float]:
    rows = labelled(scored).withColumn("label", F.col("is_fraud").cast("double"))
    return {
        "accuracy": MulticlassClassificationEvaluator(metricName="accuracy").evaluate(rows),
        "auc": BinaryClassificationEvaluator(rawPredictionCol="ml_fraud_score").evaluate(rows),
    }


# --- Versions ------------------------------------------------------------------------------------

REGISTRY = (
    "version bigint, promoted boolean, detection_rate double, false_positive_rate double, parts array<string>"
)
CLUSTERS = "columns array<string>, scale array<double>, centres array<array<double>>, typical double"


def save_models(
    spark: SparkSession,
    models: FraudModels,
    root: str,
    version: int,
    promoted: bool = True,
    detection_rate: float | None = None,
    false_positive_rate: float | None = None,
) -> None:
    """Stores one version; its line in the registry comes last, so a version is listed only when whole."""
    folder = f"{root}/version={version}"
    if models.classifier is not None:
        models.classifier.write().overwrite().save(f"{folder}/classifier")
    if models.clusters is not None:
        m = models.clusters
        row = (list(m.columns), list(m.scale), [list(c) for c in m.centres], m.typical)
        spark.createDataFrame([row], CLUSTERS).coalesce(1).write.mode("overwrite").parquet(
            f"{folder}/clusters"
        )
    parts = [p for p in ("classifier", "clusters") if getattr(models, p) is not None]
    line = (version, promoted, detection_rate, false_positive_rate, parts)
    spark.createDataFrame([line], REGISTRY).coalesce(1).write.mode("append").parquet(
        f"{root}/registry"
    )


def registry(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(REGISTRY).parquet(f"{root}/registry")


def newest_version(spark: SparkSession, root: str) -> int | None:
    return registry(spark, root).where("promoted").agg(F.max("version")).first()[0]


def load_models(
    spark: SparkSession, root: str, version: int | None = None, clusters: bool = True
) -> FraudModels:
    """A stored version, by default the newest promoted one, with the parts it was stored with."""
    version = newest_version(spark, root) if version is None else version
    if version is None:
        return FraudModels()
    folder = f"{root}/version={version}"
    parts = registry(spark, root).where(F.col("version") == version).agg(F.max("parts")).first()[0] or []
    classifier = PipelineModel.load(f"{folder}/classifier") if "classifier" in parts else None
    found = None
    if clusters and "clusters" in parts:
        row = spark.read.schema(CLUSTERS).parquet(f"{folder}/clusters").first()
        found = ClusterModel(
            tuple(row.columns), tuple(row.scale), tuple(tuple(c) for c in row.centres), row.typical
        )
    return FraudModels(classifier, found, version)


# --- Retraining and comparison -------------------------------------------------------------------


def compare_classifiers(
    holdout: DataFrame, current: PipelineModel, candidate: PipelineModel
) -> DataFrame:
    """Metrics of both models on the same rows, one row per model; the rows are scored by both in one pass.

    `holdout`: feature rows, or rows of a training table.
    """
    ready = holdout if INPUT + C.CLASSIFIER_FEATURES[0] in holdout.columns else with_inputs(holdout, C.CLASSIFIER_FEATURES)
    scored = labelled(ready)
    for name, model in (("current", current), ("candidate", candidate)):
        own = ("scaled_features_raw", "scaled_features", "rawPrediction", "probability", "prediction")
        scored = model.transform(scored).withColumn(name, F.col("prediction")).drop(*own)
    both = F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(name).alias("prediction")) for name in ("current", "candidate")
    ])
    rows = scored.select("is_fraud", F.explode(both).alias("p")).select("is_fraud", "p.*")
    return classification_metrics(rows, "is_fraud", "prediction", ("model",))


def retrain(
    features: DataFrame, current: PipelineModel, days: int, ts: str = "event_time"
) -> tuple[PipelineModel, DataFrame]:
    """Fits a candidate on the last `days` of the training rows and compares it on all hold-out rows,
    which `current` must not have been fitted on either (`plans.applications.train` sees to that).

    The features are computed once, into a training table. The result frame (two rows, kept in memory) marks the
    model to use: the candidate only if it finds at least as much fraud with no more false alarms.
    """
    named = features if ts == "event_time" else features.withColumn("event_time", F.col(ts))
    training, holdout = split_holdout(training_table(labelled(named)))
    newest = training.agg(F.max("event_time")).first()[0]
    recent = training.where(F.col("event_time") > F.lit(newest) - F.expr(f"INTERVAL {int(days)} DAYS"))
    candidate = fit_classifier(recent)
    compared = compare_classifiers(holdout, current, candidate).collect()  # two rows
    rate = {r["model"]: (r["detection_rate"] or 0.0, r["false_positive_rate"] or 0.0) for r in compared}
    better = rate["candidate"][0] >= rate["current"][0] and rate["candidate"][1] <= rate["current"][1]
    rows = [(*r, better == (r["model"] == "candidate")) for r in compared]
    names = [*compared[0].__fields__, "promoted"]
    kinds = {"model": "string", "promoted": "boolean"}
    rates = {n for n in names if n.endswith("_rate") or n in ("accuracy", "precision", "f1")}
    ddl = ", ".join(f"{n} {kinds.get(n) or ('double' if n in rates else 'bigint')}" for n in names)
    return candidate, features.sparkSession.createDataFrame(rows, ddl)


def retrain_and_promote(
    spark: SparkSession, features: DataFrame, root: str, days: int, ts: str = "event_time"
) -> int:
    """Retrains against the newest promoted version under `root`, stores the candidate as the next version and
    lists it as promoted if it is better. Streams that look models up by `load_models` then use it.
    Returns the number of the version."""
    current = load_models(spark, root)
    if current.classifier is None:
        raise ValueError(f"no promoted classifier under {root}")
    candidate, compared = retrain(features, current.classifier, days, ts)
    row = compared.where("model = 'candidate'").first()
    version = registry(spark, root).agg(F.max("version")).first()[0] + 1
    save_models(
        spark, FraudModels(candidate, current.clusters), root, version, row["promoted"],
        row["detection_rate"], row["false_positive_rate"],
    )
    return version


def retrain_if_drifted(
    spark: SparkSession, features: DataFrame, reference: DataFrame, current: DataFrame, root: str, days: int,
    limit: float = drift.LIMIT, ts: str = "event_time",
) -> int | None:
    """Retrains and lists a new version if any input or score in `current` has drifted from `reference` (states of
    `operators.drift`); returns its number, None if all is as it was. The features are read only if needed."""
    report = drift.drift_report(reference, current, limit)
    if report.where("drifted").isEmpty():
        return None
    return retrain_and_promote(spark, features, root, days, ts)


def with_arm(df: DataFrame, share_b: int = 50) -> DataFrame:
    """Arm of an A/B test by card: `share_b` percent of the cards are in B, always the same ones."""
    in_b = F.coalesce(bucket_of("cc_num") < share_b, F.lit(False))
    return df.withColumn("arm", F.when(in_b, "B").otherwise("A"))


def score_by_arm(
    df: DataFrame,
    score_a: Callable[[DataFrame], DataFrame],
    score_b: Callable[[DataFrame], DataFrame],
    share_b: int = 50,
) -> DataFrame:
    """Scores every row with the model of its arm."""
    armed = with_arm(df, share_b)
    return score_a(armed.where(F.col("arm") == "A")).unionByName(
        score_b(armed.where(F.col("arm") == "B"))
    )


# --- The scoring chain ---------------------------------------------------------------------------


def score(
    features: DataFrame, models: FraudModels = FraudModels(), config: FraudConfig = FraudConfig()
) -> DataFrame:
    """Scores, risk level, alert flag and final status. Without a classifier the tier rule is
    added and both missing scores take their fixed value."""
    df = rules.without_models(features)
    if models.classifier is not None:
        df = classify(df, models.classifier, config.classifier_score)
    else:
        df = rules.tier_rule(df)
    if models.clusters is not None:
        df = detect(df, models.clusters, config.cluster_score)
    return rules.final_status(
        rules.with_alerts(df, config.alerts), config.distance_km, config.amount
    )
