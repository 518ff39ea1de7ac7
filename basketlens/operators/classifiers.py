"""Training, comparing and scoring of classifiers, with their measures."""

from __future__ import annotations

import functools
import itertools
import random
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.dataset import Dataset
from basketlens.functions.ordering import rank_in_group, running_totals
from basketlens.functions.scalars import quoted, ratio, total_of
from basketlens.functions.shared_tables import written_table
from basketlens.operators.churn import LAST_ORDER_FEATURES, churn_dataset_last_order, churn_features
from basketlens.operators.cleaning import standard_scale
from basketlens.operators.features import PERSON, rfm_segments
from basketlens.operators.kpis import column_moments, correlations
from basketlens.operators.smote import smote_rows
from basketlens.operators.splits import seeded_order, stratified_folds, stratified_split

SEED = 42
RISK_LEVELS = [(0.3, "Low"), (0.6, "Medium")]  # fixed values: upper limits
HIGH_RISK = "High"
CONCURRENT_FITS = 8
#: Setting with the number of partitions to learn from; hundreds of short jobs
#: run over them, so raise it with the number of people, not with the cluster.
TRAINING_PARTITIONS, DEFAULT_TRAINING_PARTITIONS = "spark.basketlens.trainingPartitions", "8"


# --- measures ------------------------------------------------------------------


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n)."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count("*").alias("n"))


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support of each class, with the accuracy and
    that of always guessing the largest class; 0 where undefined."""
    cells = confusion(df, label, prediction)
    actual = cells.groupBy(F.col("label").alias("class")).agg(F.sum("n").alias("support"))
    guessed = cells.groupBy(F.col("prediction").alias("class")).agg(F.sum("n").alias("predicted"))
    right = cells.filter("label = prediction").select(F.col("label").alias("class"), F.col("n").alias("correct"))
    classes = actual.join(guessed, "class", "full").join(right, "class", "left").na.fill(0, ["support", "predicted", "correct"])
    overall = cells.agg(
        F.struct(ratio(F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)), F.sum("n")).alias("accuracy"))
    ).scalar()
    baseline = actual.agg(ratio(F.max("support"), F.sum("support")).alias("b")).scalar()
    precision = F.coalesce(ratio(F.col("correct"), F.col("predicted")), F.lit(0.0))
    recall = F.coalesce(ratio(F.col("correct"), F.col("support")), F.lit(0.0))
    return classes.select(
        "class",
        "support",
        "predicted",
        "correct",
        precision.alias("precision"),
        recall.alias("recall"),
        F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)).alias("f1"),
        overall["accuracy"].alias("accuracy"),
        baseline.alias("majority_baseline"),
    )


def _score_steps(df: DataFrame, label: str, score: str) -> DataFrame:
    """(score, pos, neg, pos_before, neg_before) per distinct score, from the
    highest down.  Equal scores merge before anything is ordered."""
    steps = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return running_totals(steps, [F.desc("score")], ["pos", "neg"])


def _thinned(steps: DataFrame, points: int | None) -> DataFrame:
    """Of all steps those at which one more of ``points`` equal parts of the
    rows is reached; the last step is always one of them."""
    if points is None:
        return steps
    rows, before = F.col("pos") + F.col("neg"), F.col("pos_before") + F.col("neg_before")
    total = total_of(steps, F.sum(rows))
    return steps.filter(F.floor((before + rows) * points / total) > F.floor(before * points / total))


def roc_curve(df: DataFrame, label: str, score: str, points: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, or for ``points`` of
    them at most, evenly over the rows, to draw."""
    steps = _score_steps(df, label, score)
    sums = steps.agg(F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))).scalar()
    return _thinned(steps, points).select(
        F.col("score").alias("threshold"),
        ratio(F.col("neg_before") + F.col("neg"), sums["neg"]).alias("fpr"),
        ratio(F.col("pos_before") + F.col("pos"), sums["pos"]).alias("tpr"),
    )


def pr_curve(df: DataFrame, label: str, score: str, points: int | None = None) -> DataFrame:
    """(threshold, precision, recall) for the same scores as ``roc_curve``."""
    steps = _score_steps(df, label, score)
    hits = F.col("pos_before") + F.col("pos")
    return _thinned(steps, points).select(
        F.col("score").alias("threshold"),
        ratio(hits, hits + F.col("neg_before") + F.col("neg")).alias("precision"),
        ratio(hits, total_of(steps, F.sum("pos"))).alias("recall"),
    )


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve, exact: the share of (positive, negative)
    pairs in the right order, ties counting half."""
    steps = _score_steps(df, label, score)
    above = F.col("pos_before").cast("double") * F.col("neg") + F.col("pos").cast("double") * F.col("neg") / 2
    return steps.agg(
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        ratio(F.sum(above), F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"),
    )


def roc_auc_by(df: DataFrame, groups: list[str], label: str, score: str) -> DataFrame:
    """(*groups, positives, negatives, roc_auc): the exact area of every group
    in one pass, ties counting half, null without both classes.

    Scores of all groups are put in one order, group by group, and counted
    through; a group's own counts are those less what came before it.  So
    no task holds a group, whatever its size.  Rows with a null group, label
    or score are left out."""
    known = df.dropna(subset=[*groups, label, score])
    steps = known.groupBy(*groups, F.col(score).cast("double").alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("_ones"), F.count_if(F.col(label) == 0).alias("_zeros")
    )
    order = [*[F.col(g) for g in groups], F.desc("_score")]
    counted = running_totals(steps, order, ["_ones"])
    exact = lambda a, b: F.col(a).cast("decimal(19,0)") * F.col(b).cast("decimal(19,0)")
    sums = counted.groupBy(*groups).agg(
        F.sum("_ones").alias("positives"),
        F.sum("_zeros").alias("negatives"),
        F.sum(exact("_ones_before", "_zeros")).alias("_above"),
        F.sum(exact("_ones", "_zeros")).alias("_tied"),
        F.min("_ones_before").alias("_first"),
    )
    twice = 2 * (F.col("_above") - exact("_first", "negatives")) + F.col("_tied")
    area = ratio(twice, 2.0 * F.col("positives") * F.col("negatives"))
    return sums.select(*groups, "positives", "negatives", area.alias("roc_auc"))


# --- data preparation ------------------------------------------------------------


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add n / (classes * n of the class), so that all classes weigh the same."""
    sizes = df.groupBy(label).agg(F.count("*").alias("_n"))
    total = sizes.agg(F.struct(F.sum("_n").alias("n"), F.count("*").alias("k"))).scalar()
    weights = sizes.select(label, (total["n"] / (total["k"] * F.col("_n"))).alias(name))
    # one row per class on the right
    return df.join(F.broadcast(weights), label)


def oversample(df: DataFrame, key: str, label: str, seed: int = SEED) -> DataFrame:
    """Repeat rows of the smaller classes until all are as large as the
    largest; the rows repeated once more than others are chosen by hash."""
    ranked = rank_in_group(df.withColumn("_o", seeded_order(key, seed)), label, [F.col("_o"), F.col(key)], "_r")
    sizes = ranked.groupBy(label).agg(F.count("*").alias("_n"))
    largest = total_of(sizes, F.max("_n"))
    sized = ranked.join(F.broadcast(sizes), label).withColumn("_most", largest)
    extra = (F.col("_r") <= F.col("_most") % F.col("_n")).cast("int")
    times = F.floor(F.col("_most") / F.col("_n")) + extra
    return sized.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), times.cast("long")))).drop("_o", "_r", "_n", "_most")


def preprocess_features(
    df: DataFrame, columns: list[str], max_corr: float = 0.95, min_variance: float = 0.0
) -> tuple[DataFrame, list[str]]:
    """Standardised columns without near-constant ones and without the second
    of each highly correlated pair.  Only per-column figures, one row per
    column or pair, reach the driver."""
    moments = column_moments(df, columns).collect()
    varied = [c for c in columns if any(m["column"] == c and m["std"] is not None and m["std"] ** 2 > min_variance for m in moments)]
    twins = correlations(df, varied, min_abs=max_corr, top=None).collect()
    dropped: set[str] = set()
    for pair in sorted(twins, key=lambda t: (varied.index(t["column_1"]), varied.index(t["column_2"]))):
        if pair["column_1"] not in dropped:
            dropped.add(pair["column_2"])
    kept = [c for c in varied if c not in dropped]
    others = [c for c in df.columns if c not in columns]
    return standard_scale(df.select(*others, *kept), kept), kept


# --- models ------------------------------------------------------------------------


def gradient_boosting(label: str, **settings) -> GBTClassifier:
    """100 trees of depth 5 at rate 0.1 unless set otherwise."""
    return GBTClassifier(labelCol=label, **{"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "seed": SEED, **settings})


def classifiers(label: str) -> dict[str, Estimator]:
    """The learners to compare, with the reference settings."""
    return {
        "Logistic Regression": LogisticRegression(labelCol=label, maxIter=1000),
        "Decision Tree": DecisionTreeClassifier(labelCol=label, maxDepth=10, seed=SEED),
        "Random Forest": RandomForestClassifier(labelCol=label, numTrees=100, seed=SEED),
        "Gradient Boosting": gradient_boosting(label, maxDepth=3),
        "Naive Bayes": NaiveBayes(labelCol=label, modelType="gaussian"),
        "SVM (Linear)": LinearSVC(labelCol=label),
    }


def right_sized(df: DataFrame, order: tuple[str, ...] = (PERSON,)) -> DataFrame:
    """The rows dealt by person over a fixed number of partitions, in order.
    Learners bag and sum per partition, so what they fit depends on the
    number that is set (``spark.basketlens.trainingPartitions``) and not on
    the size of files."""
    partitions = int(df.sparkSession.conf.get(TRAINING_PARTITIONS, DEFAULT_TRAINING_PARTITIONS))
    return df.repartition(partitions, PERSON).sortWithinPartitions(*order)


def with_vector(estimator: Estimator, features: list[str]) -> Pipeline:
    """Assemble, standardise, learn."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=features, outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True),
            estimator,
        ]
    )


def probability_of_one(model: Model, df: DataFrame) -> DataFrame:
    """Predictions with ``score``: the probability of class 1, or the raw
    margin where the learner has no probabilities."""
    predicted = model.transform(df)
    source = "probability" if "probability" in predicted.columns else "rawPrediction"
    return predicted.withColumn("score", F.get(vector_to_array(source), F.lit(1)))


def train_churn(
    data: DataFrame, features: list[str] = LAST_ORDER_FEATURES, label: str = "churn", test_size: float = 0.2, estimator: Estimator | None = None
) -> tuple[PipelineModel, DataFrame]:
    """Fit on a stratified training part; returns the model and the held-out
    rows with predictions."""
    split = written_table(stratified_split(data, PERSON, label, test_size, SEED), "churn-split")
    pipeline = Pipeline(
        stages=[VectorAssembler(inputCols=features, outputCol="features"), estimator or gradient_boosting(label)]
    )
    model = pipeline.fit(right_sized(split.filter("split = 'train'")))
    return model, probability_of_one(model, split.filter("split = 'test'"))


def feature_importance(model: PipelineModel, features: list[str], spark, top: int = 15) -> DataFrame:
    """(feature, importance), largest first; absolute coefficients for linear
    learners.  As many rows as features."""
    learner = model.stages[-1]
    weights = learner.featureImportances if hasattr(learner, "featureImportances") else learner.coefficients
    rows = [(name, abs(float(weights[i]))) for i, name in enumerate(features)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(top)


def churn_report(data: DataFrame, features: list[str] = LAST_ORDER_FEATURES, label: str = "churn", estimator: Estimator | None = None) -> DataFrame:
    """Per-class measures and ROC-AUC on held-out people."""
    _, predicted = train_churn(data, features, label, estimator=estimator)
    held = written_table(predicted.select(label, F.col("prediction").cast("int").alias("prediction"), "score"), "held-out")
    area = total_of(roc_auc(held, label, "score"), F.max("roc_auc"))
    return classification_metrics(held, label, "prediction").withColumn("roc_auc", area)


def score_churn(model: PipelineModel, data: DataFrame, segments: DataFrame) -> DataFrame:
    """Probability, decision, risk level and segment of every person, from
    the same features the model was trained on."""
    scored = probability_of_one(model, data)
    level = F.lit(HIGH_RISK)
    for limit, name in reversed(RISK_LEVELS):
        level = F.when(F.col("churn_probability") < limit, name).otherwise(level)
    return (
        scored.select(PERSON, F.col("score").alias("churn_probability"), (F.col("prediction") == 1).alias("will_churn"))
        .withColumn("risk_level", level)
        .join(segments.select(PERSON, "segment"), PERSON, "left")
        .na.fill("Unknown", ["segment"])
    )


def score_all_customers(ds: Dataset, estimator: Estimator | None = None, window_days: int = 90) -> DataFrame:
    """Train on people with two or more orders, and score everybody, people
    with one order too, by the features of all their orders."""
    data = written_table(churn_dataset_last_order(ds, window_days), "churn-data")
    model, _ = train_churn(data, estimator=estimator)
    return score_churn(model, churn_features(ds), rfm_segments(ds))


def at_risk_customers(scores: DataFrame, threshold: float = 0.6, n: int = 100) -> DataFrame:
    """The ``n`` people most likely to churn, above a threshold."""
    return scores.filter(F.col("churn_probability") > threshold).orderBy(F.desc("churn_probability"), PERSON).limit(n)


def _scaled_parts(train: DataFrame, test: DataFrame, features: list[str], label: str, balance: str) -> tuple[DataFrame, DataFrame]:
    """Both parts with standardised ``features`` vectors, written once for all
    learners.  Means and deviations, and with ``balance="smote"`` the rows
    between neighbours, come from the training part alone."""
    steps = [VectorAssembler(inputCols=features, outputCol="raw_features"), StandardScaler(inputCol="raw_features", outputCol="features", withMean=True)]
    scale = Pipeline(stages=steps).fit(train)
    weight = ["weight"] if "weight" in train.columns else []
    learned = scale.transform(train).select(PERSON, label, *weight, "features")
    held = scale.transform(test).select(PERSON, label, *weight, "features")
    order = (PERSON,)
    if balance == "smote":
        names = [f"_f{j}" for j in range(len(features))]
        values = vector_to_array("features")
        apart = learned.select(PERSON, label, *[F.get(values, F.lit(j)).alias(n) for j, n in enumerate(names)])
        more = smote_rows(apart, PERSON, label, names).select(PERSON, label, "copy", *names)
        every = apart.withColumn("copy", F.lit(0)).unionByName(more)
        learned = VectorAssembler(inputCols=names, outputCol="features").transform(every).select(PERSON, label, "copy", "features")
        order = (PERSON, "copy")
    return right_sized(written_table(learned, "learned"), order), right_sized(written_table(held, "held-out"))


def held_out_scores(
    parts: dict[int, tuple[DataFrame, DataFrame]], features: list[str], label: str, learners: dict[str, Estimator], balance: str = "weights"
) -> DataFrame:
    """(model, fold, label, prediction, score) of the test rows of every part,
    by every learner fitted to the part's training rows.  The fits are
    independent Spark jobs and are submitted side by side."""
    frame = next(iter(parts.values()))[0]
    ready = dict(zip(parts, _side_by_side(lambda fold: _scaled_parts(*parts[fold], features, label, balance), list(parts), frame)))

    def scored(task: tuple[str, int]) -> DataFrame:
        name, fold = task
        train, test = ready[fold]
        found = probability_of_one(learners[name].fit(train), test)
        columns = [F.lit(name).alias("model"), F.lit(fold).alias("fold"), F.col(label).alias("label")]
        return written_table(found.select(*columns, F.col("prediction").cast("int").alias("prediction"), "score"), "scored")

    tasks = [(name, fold) for name in learners for fold in parts]
    return functools.reduce(DataFrame.unionByName, _side_by_side(scored, tasks, frame))


def _side_by_side(work: Callable, tasks: list, df: DataFrame) -> list:
    """Run driver-side calls that start Spark jobs in a few threads."""
    wrapped = inheritable_thread_target(df.sparkSession)(work)
    with ThreadPool(min(CONCURRENT_FITS, len(tasks))) as pool:
        return pool.map(wrapped, tasks, chunksize=1)


def _fold_parts(folded: DataFrame, folds: int) -> dict[int, tuple[DataFrame, DataFrame]]:
    return {k: (folded.filter(F.col("fold") != k), folded.filter(F.col("fold") == k)) for k in range(folds)}


def cross_validate(
    data: DataFrame, features: list[str], label: str, estimator: Estimator, folds: int = 5, balance: str = "weights"
) -> DataFrame:
    """(fold, positives, negatives, roc_auc, roc_auc_mean, roc_auc_std): the
    exact ROC-AUC of each stratified fold, with mean and (population)
    deviation over the folds."""
    folded = right_sized(written_table(stratified_folds(data, PERSON, label, folds, SEED), "folds"))
    scores = held_out_scores(_fold_parts(folded, folds), features, label, {"": estimator}, balance)
    areas = roc_auc_by(scores, ["fold"], "label", "score")
    every = W.partitionBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)  # a row per fold
    return areas.select(
        "*", F.avg("roc_auc").over(every).alias("roc_auc_mean"), F.stddev_pop("roc_auc").over(every).alias("roc_auc_std")
    )


def compare_models(
    data: DataFrame,
    features: list[str],
    label: str,
    learners: dict[str, Estimator] | None = None,
    folds: int = 5,
    balance: str = "weights",
) -> DataFrame:
    """The same data through several learners: held-out accuracy, precision,
    recall, F1 and ROC-AUC, with the cross-validated ROC-AUC.

    ``balance``: "weights" gives learners that take weights balanced classes,
    "smote" gives all learners synthetic rows of the smaller class, made from
    each training part alone, "none" leaves the classes as they are."""
    if balance not in ("weights", "smote", "none"):
        raise ValueError(f"unknown balance: {balance}")
    split = written_table(class_weights(stratified_split(data, PERSON, label, 0.2, SEED), label), "compare-split")
    train, test = right_sized(split.filter("split = 'train'")), right_sized(split.filter("split = 'test'"))
    learning = {name: learner.copy() for name, learner in (learners or classifiers(label)).items()}
    for learner in learning.values():
        if balance == "weights" and learner.hasParam("weightCol"):
            learner.set(learner.weightCol, "weight")
    folded = right_sized(written_table(stratified_folds(train.drop("split"), PERSON, label, folds, SEED), "folds"))
    whole = -1  # beside the folds: all of the training part against the test part
    scores = held_out_scores({whole: (train, test), **_fold_parts(folded, folds)}, features, label, learning, balance)
    areas = written_table(roc_auc_by(scores, ["model", "fold"], "label", "score"), "areas")
    validated = areas.filter(F.col("fold") != whole).groupBy("model").agg(
        F.avg("roc_auc").alias("cv_roc_auc_mean"), F.stddev_pop("roc_auc").alias("cv_roc_auc_std")
    )
    right, found, actual = F.col("label") == F.col("prediction"), F.col("prediction") == 1, F.col("label") == 1
    counts = scores.filter(F.col("fold") == whole).groupBy("model").agg(
        F.avg(right.cast("int")).alias("accuracy"),
        F.count_if(right & found).alias("_hits"),
        F.count_if(found).alias("_found"),
        F.count_if(actual).alias("_actual"),
    )
    precision, recall = (F.coalesce(ratio(F.col("_hits"), F.col(c)), F.lit(0.0)) for c in ("_found", "_actual"))
    measures = counts.select(
        "model",
        "accuracy",
        precision.alias("precision"),
        recall.alias("recall"),
        F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)).alias("f1"),
    )
    held = areas.filter(F.col("fold") == whole).select("model", "roc_auc")
    # a row per learner
    return measures.join(held, "model").join(validated, "model").orderBy(F.desc("roc_auc"), "model")


def tune_model(
    data: DataFrame, features: list[str], label: str, estimator: Estimator, space: dict[str, list], n_iter: int = 10, folds: int = 3
) -> DataFrame:
    """Random search: ``n_iter`` settings drawn from the space, by ROC-AUC."""
    names = list(space)
    settings = [dict(zip(names, values)) for values in itertools.product(*space.values())]
    random.Random(SEED).shuffle(settings)
    chosen = settings[:n_iter]
    grid = []
    for setting in chosen:
        builder = ParamGridBuilder()
        for name, value in setting.items():
            builder = builder.addGrid(estimator.getParam(name), [value])
        grid.extend(builder.build())
    folded = right_sized(written_table(stratified_folds(data, PERSON, label, folds, SEED), "tuning"))
    fitted = CrossValidator(
        estimator=with_vector(estimator, features),
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(labelCol=label),
        numFolds=folds,
        foldCol="fold",
        parallelism=CONCURRENT_FITS,
    ).fit(folded)
    rows = [(", ".join(f"{k}={v}" for k, v in s.items()), float(m)) for s, m in zip(chosen, fitted.avgMetrics)]
    found = data.sparkSession.createDataFrame(rows, "setting string, roc_auc double")
    # a handful of settings
    return found.withColumn("rank", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.desc("roc_auc"), "setting")))
