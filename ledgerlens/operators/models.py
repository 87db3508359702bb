"""Regression and classification of returns, with random search and cross-validation.

Candidates are drawn on the driver from a seed; every fit and every score is a Spark job.
"""

from __future__ import annotations

import json
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.evaluate import classifier_metrics, regression_metrics, roc_auc, summarise_folds
from ledgerlens.operators.search import fit_boosted, linear_scores, tree_scores
from ledgerlens.operators.split import RETURN_THRESHOLD, SEED, TEST_SIZE, above, folds, stratified_split
from ledgerlens.operators.sparse import summed_parts
from ledgerlens.session import compact, stage

# Search settings.
ALPHA_MIN, ALPHA_MAX, N_ALPHAS = 0.0001, 1.0, 50
JOB_ALPHA = 0.001
CV_FOLDS = 5
N_ITER_SEARCH = 20
CLASSIFIER_ITER = 1000
# Up to this width the sums of products of a fold, 32 MB, are held by a task and, for all folds, by the driver.
MOMENT_FEATURES = 2_000
LINEAR_KINDS = ("LogisticRegression", "SVM")
# Final fits that run at the same time.
FIT_THREADS = 4

# Search spaces. Spark trees are at most 30 deep and have a minimum per leaf instead of per split; the
# support vector machine is linear.
SEARCH_SPACES = {
    "LogisticRegression": {"C": ("log", 1e-4, 1e3), "penalty": ["l1", "l2"], "balanced": [False, True]},
    "SVM": {"C": ("log", 1e-4, 1e3), "balanced": [False, True]},
    "RandomForest": {
        "trees": ("int", 50, 499),
        "depth": ("int", 2, 30),
        "leaf": ("int", 1, 19),
        "features": ["sqrt", "log2", "all"],
        "balanced": [False, True],
    },
    "GradientBoosting": {
        "trees": ("int", 50, 499),
        "rate": ("log", 1e-4, 1.0),
        "depth": ("int", 2, 30),
        "subsample": ("uniform", 0.5, 1.0),
        "leaf": ("int", 1, 19),
    },
}


def draw(space: dict, rng: random.Random) -> dict:
    """One random candidate from a search space."""
    candidate = {}
    for name, spec in space.items():
        if isinstance(spec, list):
            candidate[name] = rng.choice(spec)
        elif spec[0] == "int":
            candidate[name] = rng.randint(spec[1], spec[2])
        elif spec[0] == "log":
            candidate[name] = spec[1] * (spec[2] / spec[1]) ** rng.random()
        else:
            candidate[name] = rng.uniform(spec[1], spec[2])
    return candidate


def lasso(alpha: float, features: str = "features", label: str = "label", max_iter: int = 1000) -> LinearRegression:
    """Lasso with the objective ``|y - Xb|^2 / 2n + alpha |b|_1``.

    Up to 4,096 features Spark sums the moments in one pass over the data and solves on them; beyond that it makes a
    pass per step.
    """
    return LinearRegression(
        featuresCol=features,
        labelCol=label,
        elasticNetParam=1.0,
        regParam=alpha,
        standardization=False,
        maxIter=max_iter,
        tol=1e-9,
        solver="auto",
    )


def coefficient_table(spark: SparkSession, values, names: list[str] | None = None) -> DataFrame:
    """Model weights with their names, or ``Feature i`` when the names do not fit."""
    numbers = [float(v) for v in values]
    if names is None or len(names) != len(numbers):
        names = [f"Feature {i}" for i in range(len(numbers))]
    rows = [(i, name, v) for i, (name, v) in enumerate(zip(names, numbers))]
    return spark.createDataFrame(rows, "position int, feature string, importance double")


def feature_importance(spark: SparkSession, model, names: list[str] | None = None) -> DataFrame | None:
    """Importance of the features of a fitted model, highest first (F5); None for a model that has none."""
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif hasattr(model, "coefficientMatrix"):
        values = abs(model.coefficientMatrix.toArray()).mean(axis=0)
    elif hasattr(model, "coefficients"):
        values = abs(model.coefficients.toArray())
    else:
        return None
    return coefficient_table(spark, values, names).orderBy(F.desc("importance"), "position")


def nonzero_coefficients(table: DataFrame) -> DataFrame:
    """Coefficients other than 0, highest first."""
    return table.where(F.col("importance") != 0).orderBy(F.desc("importance"), "position")


def coefficient_extremes(table: DataFrame) -> DataFrame:
    """Number of non-zero coefficients and the most positive and most negative one."""
    return table.agg(
        F.count_if(F.col("importance") != 0).alias("nonzero"),
        F.max_by("feature", F.struct(F.col("importance"), -F.col("position"))).alias("most_positive"),
        F.max("importance").alias("most_positive_coef"),
        F.min_by("feature", F.struct("importance", "position")).alias("most_negative"),
        F.min("importance").alias("most_negative_coef"),
    )


def top_features(table: DataFrame, n: int = 10) -> DataFrame:
    """Top features by absolute value."""
    return table.orderBy(F.desc(F.abs("importance")), "feature").limit(n)


def top_features_signed(table: DataFrame, n: int = 20) -> DataFrame:
    """Top features by absolute value, shown in order of their value."""
    return top_features(table, n).orderBy("importance", "feature")


def group_importance(table: DataFrame, groups: DataFrame) -> DataFrame:
    """Sum of absolute importances per feature group, highest first (C7, D22, F11); unknown features count 0."""
    joined = groups.join(table.select("feature", "importance"), "feature", "left")
    total = F.sum(F.abs(F.coalesce("importance", F.lit(0.0))))
    return joined.groupBy("group").agg(total.alias("importance")).orderBy(F.desc("importance"), "group")


def build(kind: str, params: dict, features: str = "features", label: str = "label", seed: int = SEED, rows: int = 1):
    """Estimator of one kind with the parameters of a candidate; ``rows`` is the number of rows that it will be fitted on.

    The penalty is the one on plain coefficients, as in the Lasso, not on those of standardised features.
    """
    common = {"featuresCol": features, "labelCol": label}
    if params.get("balanced"):
        common["weightCol"] = "_weight"
    if kind == "LogisticRegression":
        mix = 1.0 if params.get("penalty", "l2") == "l1" else 0.0
        penalty = {"regParam": 1.0 / (params["C"] * rows), "elasticNetParam": mix, "standardization": False}
        return LogisticRegression(maxIter=CLASSIFIER_ITER, **penalty, **common)
    if kind == "SVM":
        return LinearSVC(maxIter=CLASSIFIER_ITER, regParam=1.0 / (params["C"] * rows), standardization=False, **common)
    if kind == "RandomForest":
        return RandomForestClassifier(
            numTrees=params.get("trees", 50),
            maxDepth=min(params.get("depth", 5), 30),
            minInstancesPerNode=params.get("leaf", 1),
            featureSubsetStrategy=params.get("features", "sqrt"),
            seed=seed,
            **common,
        )
    if kind == "GradientBoosting":
        return GBTClassifier(
            maxIter=params.get("trees", 50),
            stepSize=params.get("rate", 0.1),
            maxDepth=min(params.get("depth", 5), 30),
            subsamplingRate=params.get("subsample", 1.0),
            minInstancesPerNode=params.get("leaf", 1),
            seed=seed,
            **common,
        )
    raise ValueError(f"unknown model: {kind}")


def add_balance_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Weight ``rows / (classes * rows of the class)``, so that all classes weigh the same."""
    return with_balance_weight(df, {r[0]: r[1] for r in df.groupBy(label).count().collect()}, label)


def with_balance_weight(df: DataFrame, counts: dict, label: str = "label") -> DataFrame:
    """The same weight from counts that are known already."""
    total = sum(counts.values())
    weight = F.lit(None).cast("double")
    for value, n in counts.items():
        weight = F.when(F.col(label) == value, total / (len(counts) * n)).otherwise(weight)
    return df.withColumn("_weight", weight)


def evaluate_classifier(model, df: DataFrame, label: str = "label") -> DataFrame:
    """Accuracy, macro scores and ROC AUC, as one row (I20). AUC needs a ranking only: the probability of class 1, or for
    the support vector machine its raw score."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(df)
    result = classifier_metrics(scored, label, "prediction")
    ranking = next((c for c in ("probability", "rawPrediction") if c in scored.columns), None)
    if ranking is None:
        return result.withColumn("roc_auc", F.lit(None).cast("double"))
    ranked = scored.select(F.col(label), vector_to_array(ranking)[1].alias("_p"))
    auc = roc_auc(ranked, "_p", label).first()["roc_auc"]
    return result.withColumn("roc_auc", F.lit(auc).cast("double"))


def fold_scores(estimator, df: DataFrame, k: int, label: str, regression: bool) -> DataFrame:
    """Train and test scores of each fold: ``(side, metric, fold, value)``; ``df`` has a ``fold`` column.

    The folds are fitted at the same time, as an iterative fit is many short jobs that leave most cores idle. One
    pass over the rows gives what all models predict, and the scores of all folds and sides come from its sums.
    """

    def fit(fold: int):
        return estimator.copy().fit(df.where(F.col("fold") != fold))

    with ThreadPoolExecutor(FIT_THREADS) as pool:
        fitted = list(pool.map(fit, range(k)))
    added = [c for c in fitted[0].transform(df.limit(0)).columns if c not in df.columns and c != "prediction"]
    scored = df
    for fold, model in enumerate(fitted):
        scored = model.transform(scored).withColumnRenamed("prediction", f"_prediction_{fold}").drop(*added)
    sides = F.inline(F.array(*[
        F.struct(
            F.when(F.col("fold") == fold, "test").when(F.col("fold") != fold, "train").alias("side"),
            F.lit(fold).alias("held"),
            F.col(f"_prediction_{fold}").alias("prediction"),
        )
        for fold in range(k)
    ]))
    rows = scored.select(F.col(label), sides).where("side is not null").withColumnRenamed("held", "fold")
    if regression:
        wide = regression_metrics(rows, label, "prediction", ["side", "fold"]).select(
            "side",
            "fold",
            (-F.col("mse")).alias("neg_mean_squared_error"),
            (-F.col("rmse")).alias("neg_root_mean_squared_error"),
            "r2",
        )
    else:
        wide = classifier_metrics(rows, label, "prediction", ["side", "fold"])
    names = [c for c in wide.columns if c not in ("side", "fold")]
    # A fold without rows has scores too, which are null.
    grid = df.sparkSession.createDataFrame([(side, fold) for side in ("test", "train") for fold in range(k)], "side string, fold int")
    wide = F.broadcast(grid).join(wide, ["side", "fold"], "left")
    found = stage(wide.unpivot(["side", "fold"], names, "metric", "value"), "fold-scores")
    return found.select("side", "metric", "fold", "value")


def cross_validate(
    estimator,
    df: DataFrame,
    key: str,
    label: str = "label",
    k: int = CV_FOLDS,
    regression: bool = False,
    scoring: list[str] | None = None,
) -> DataFrame:
    """Mean, deviation and values of the scores over k folds, for the test and the train side."""
    stratum = df.withColumn("_one", F.lit(0)) if regression else df
    folded = compact(stage(folds(stratum, key, "_one" if regression else label, k), "cv-folds"))
    scores = fold_scores(estimator, folded, k, label, regression)
    if scoring is not None:
        scores = scores.where(F.col("metric").isin(scoring))
    sides = []
    for side in ("test", "train"):
        summary = summarise_folds(scores.where(F.col("side") == side))
        sides.append(summary.select(F.lit(side).alias("side"), "metric", "mean", "std", "values"))
    return sides[0].unionByName(sides[1])


def mean_fold_score(estimator, folded: DataFrame, k: int, label: str, regression: bool, fold_train=None) -> float:
    """Mean test score: macro F1 for classes, negative RMSE for numbers. One scoring job per candidate.

    ``estimator`` is one, or a function that makes one for the fold that is held out; ``fold_train`` gives that fold's
    training rows where they are more than the rows of the other folds.
    """
    predictions = None
    for fold in range(k):
        train = folded.where(F.col("fold") != fold) if fold_train is None else fold_train(fold)
        model = (estimator(fold) if callable(estimator) else estimator).fit(train)
        part = model.transform(folded.where(F.col("fold") == fold)).select("fold", label, "prediction")
        predictions = part if predictions is None else predictions.unionByName(part)
    if regression:
        scores = regression_metrics(predictions, label, "prediction", ["fold"])
        return scores.agg(-F.avg("rmse")).first()[0]
    return classifier_metrics(predictions, label, "prediction", ["fold"]).agg(F.avg("f1_macro")).first()[0]


def fold_moments(folded: DataFrame, k: int, label: str, features: str = "features"):
    """For each fold the row count and the sums of products of (1, x, y), from one pass over the rows.

    A task sums its own rows; (p + 2)^2 numbers of each fold come back, however many rows there are. They are added in parts,
    so that no task holds the sums of many others.
    """
    import numpy as np
    from pyspark.ml.functions import vector_to_array

    size = len(folded.select(vector_to_array(features).alias("v")).first()["v"]) + 2

    def sums(batches):
        import numpy as np

        total, most = {}, max(1, 2_000_000 // size)
        for whole in batches:
            for start in range(0, whole.num_rows, most):
                batch = whole.slice(start, most)
                x = np.array(batch.column(1).flatten().to_numpy(zero_copy_only=False), float).reshape(batch.num_rows, size - 2)
                y, fold = batch.column(2).to_numpy(), batch.column(0).to_numpy()
                rows = np.concatenate([np.ones((len(y), 1)), x, y[:, None]], axis=1)
                for f in np.unique(fold):
                    own = rows[fold == f]
                    total[int(f)] = total.get(int(f), 0) + own.T @ own
        for f, matrix in total.items():
            yield f, matrix.ravel()

    rows = folded.select(F.col("fold").cast("int"), vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    found = summed_parts(rows, sums)
    return np.array([found.get(f, np.zeros(size * size)).reshape(size, size) for f in range(k)])


def lasso_path(total, alphas: list[float], rounds: int = 10_000, tolerance: float = 1e-12) -> list:
    """Coefficients and intercept of the Lasso for each alpha, by coordinate descent on the sums of products.

    Alphas are solved from the largest to the smallest, each from the coefficients of the one before. Only features that the
    sequential strong rule keeps are visited; the optimality condition of all others is tested afterwards, and those that
    fail it join until none does, so the rule decides the work and not the result.
    """
    import numpy as np

    n = total[0, 0]
    mean = total[0] / n
    covariance = total / n - np.outer(mean, mean)
    gram, target = covariance[1:-1, 1:-1], covariance[1:-1, -1]
    spread = np.diag(gram).copy()
    b, pull, solved = np.zeros(len(target)), target.copy(), {}
    before = np.abs(target).max(initial=0.0)
    for alpha in sorted(set(alphas), reverse=True):
        kept = (spread > 0) & ((np.abs(pull) >= 2 * alpha - before) | (b != 0))
        while True:
            own = np.flatnonzero(kept)
            inner, local, rest = gram[np.ix_(own, own)], b[own], pull[own]
            for _ in range(rounds):
                change = 0.0
                for j in range(len(own)):
                    wanted = rest[j] + inner[j, j] * local[j]
                    new = np.sign(wanted) * max(abs(wanted) - alpha, 0) / inner[j, j]
                    if new != local[j]:
                        rest -= inner[j] * (new - local[j])
                        change = max(change, abs(new - local[j]) * np.sqrt(inner[j, j]))
                        local[j] = new
                if change < tolerance:
                    break
            b[own] = local
            pull = target - gram @ b
            missed = (spread > 0) & ~kept & (np.abs(pull) > alpha * (1 + 1e-9))
            if not missed.any():
                break
            kept |= missed
        solved[alpha], before = (b.copy(), mean[-1] - mean[1:-1] @ b), alpha
    return [solved[alpha] for alpha in alphas]


def lasso_gradients(rows: DataFrame, label: str, features: str, fitted: list):
    """For each ``(coefficients, intercept)`` the mean over the rows of each feature times the rest that the model leaves.

    One pass serves all models and reads the cells of sparse vectors as they are; models x features numbers come back. Rows
    without a label are left out; None without any row.
    """
    import numpy as np

    weights = np.array([b for b, _ in fitted], float).T
    intercepts = np.array([intercept for _, intercept in fitted], float)

    def run(batches):
        import numpy as np

        total = np.zeros((len(weights), len(intercepts)))
        count = 0
        for batch in batches:
            lists, x, y = batch.column(1), batch.column(2).flatten().to_numpy(), batch.column(0).to_numpy()
            row, column = lists.value_parent_indices().to_numpy(), lists.flatten().to_numpy()
            for m, intercept in enumerate(intercepts):
                rest = y - (np.bincount(row, x * weights[column, m], len(y)) + intercept)
                total[:, m] += np.bincount(column, x * rest[row], len(weights))
            count += len(y)
        yield 0, np.r_[total.ravel(), count]

    v = F.unwrap_udt(features)
    opened = rows.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("y"), v.alias("v"))
    places = F.coalesce(F.col("v.indices"), F.sequence(F.lit(0), F.size("v.values") - 1))
    found = summed_parts(opened.select("y", places.alias("i"), F.col("v.values").alias("x")), run).get(0)
    return None if found is None or not found[-1] else found[:-1].reshape(weights.shape).T / found[-1]


def lasso_on_moments(total, alpha: float, rounds: int = 10_000, tolerance: float = 1e-12):
    """Coefficients and intercept of the Lasso for one alpha."""
    return lasso_path(total, [alpha], rounds, tolerance)[0]


def lasso_fold_scores(moments, alphas: list[float]) -> list[float]:
    """For each alpha the mean over the folds of the negative RMSE, each fold scored by the model of the others."""
    import numpy as np

    scores, whole = [], moments.sum(axis=0)
    for held in moments:
        if not held[0, 0]:
            continue
        rest = [np.concatenate([[-intercept], -b, [1.0]]) for b, intercept in lasso_path(whole - held, alphas)]
        scores.append([-np.sqrt(max(r @ held @ r, 0.0) / held[0, 0]) for r in rest])
    return [float(s) for s in np.mean(scores, axis=0)]


def lasso_fold_score(moments, alpha: float) -> float:
    return lasso_fold_scores(moments, [alpha])[0]


def train_lasso(
    df: DataFrame,
    key: str,
    label: str,
    names: list[str] | None = None,
    alphas: int = N_ALPHAS,
    alpha_range: tuple[float, float] = (ALPHA_MIN, ALPHA_MAX),
    test_size: float = TEST_SIZE,
    k: int = CV_FOLDS,
    seed: int = SEED,
) -> dict:
    """Lasso with a seeded random search over alpha (I16).

    Up to ``MOMENT_FEATURES`` features one pass sums the moments of every fold, and all candidates are solved and scored on
    them; beyond that each candidate and fold is a fit.
    """
    present = df.where(F.col(label).isNotNull() & ~F.isnan(label))
    parts = stratified_split(present.withColumn("_one", F.lit(0)), key, "_one", test_size, 0.0, seed)
    parts = stage(parts, "lasso-parts")
    train, test = compact(parts.where("split = 'train'")), parts.where("split = 'test'")
    folded = compact(stage(folds(train.drop("split"), key, "_one", k, seed), "lasso-folds"))
    rng = random.Random(seed)
    candidates = [rng.uniform(*alpha_range) for _ in range(alphas)]
    if len(folded.select("features").first()["features"]) <= MOMENT_FEATURES:
        moments = fold_moments(folded, k, label)
        scores = lasso_fold_scores(moments, candidates)
    else:
        scores = [mean_fold_score(lasso(a, label=label), folded, k, label, True) for a in candidates]
    best = max(range(alphas), key=lambda i: scores[i])
    model = lasso(candidates[best], label=label).fit(train)
    spark = df.sparkSession
    table = coefficient_table(spark, model.coefficients, names)
    return {
        "model": model,
        "best_alpha": candidates[best],
        "search": spark.createDataFrame(list(zip(candidates, scores)), "alpha double, score double"),
        "coefficients": table,
        "nonzero": nonzero_coefficients(table),
        "summary": coefficient_extremes(table),
        "test_metrics": regression_metrics(model.transform(test), label, "prediction"),
    }


def train_classifiers(
    df: DataFrame,
    key: str,
    returns: str,
    threshold: float = RETURN_THRESHOLD,
    test_size: float = TEST_SIZE,
    n_iter: int = N_ITER_SEARCH,
    k: int = CV_FOLDS,
    kinds: list[str] | None = None,
    spaces: dict | None = None,
    seed: int = SEED,
) -> dict:
    """Random search for four kinds of classifiers; the best is the one with the highest macro F1 on test.

    Candidates of all folds are cross-validated together (``search``). The best of each kind is then fitted on all training rows
    and measured on all test rows.
    """
    spaces = SEARCH_SPACES if spaces is None else spaces
    labelled = df.withColumn("label", above(returns, threshold))
    parts = stage(stratified_split(labelled, key, "label", test_size, 0.0, seed), "class-parts")
    train = parts.where("split = 'train'").drop("split")
    test = parts.where("split = 'test'")
    folded = compact(stage(folds(train, key, "label", k, seed), "class-folds"))
    # Rows of each fold and class: sizes and weights of a fold's training side leave the held-out rows aside.
    sizes = {(r["fold"], r["label"]): r["n"] for r in folded.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()}

    def class_counts(held_out=None) -> dict:
        counts: dict = {}
        for (fold, value), n in sizes.items():
            if fold != held_out:
                counts[value] = counts.get(value, 0) + n
        return counts

    everything = class_counts()
    weighted = with_balance_weight(folded, everything)
    wanted = kinds or list(spaces)
    drawn = {kind: [draw(spaces[kind], rng) for _ in range(n_iter)] for kind in wanted for rng in [random.Random(f"{seed}|{kind}")]}
    linear = [(kind, c) for kind in wanted if kind in LINEAR_KINDS for c in drawn[kind]]
    trees = [(kind, c) for kind in wanted if kind not in LINEAR_KINDS for c in drawn[kind]]

    def finish(kind, search):
        """Fit the best candidate of a kind on all training rows and measure it on the test rows."""
        (_, params), score = max((x for x in search.result() if x[0][0] == kind), key=lambda x: x[1])
        if kind == "GradientBoosting":
            model = fit_boosted(folded, key, "label", params, seed)
        else:
            model = build(kind, params, rows=sum(everything.values())).fit(weighted)
        f1 = classifier_metrics(model.transform(test), "label", "prediction").first()["f1_macro"]
        return (kind, json.dumps(params), score, f1), model

    # Passes of the linear search are short jobs that leave cores idle, so the trees are grown at the same time; the best of a kind is
    # fitted as soon as its own search has ended.
    with ThreadPoolExecutor(2) as searches, ThreadPoolExecutor(FIT_THREADS) as pool:
        of_linear = searches.submit(lambda: list(zip(linear, linear_scores(folded, k, "label", linear, sizes))) if linear else [])
        of_trees = searches.submit(lambda: list(zip(trees, tree_scores(folded, k, key, "label", trees, seed))) if trees else [])
        done = list(pool.map(lambda kind: finish(kind, of_linear if kind in LINEAR_KINDS else of_trees), wanted))
    results, models = [row for row, _ in done], {kind: model for kind, (_, model) in zip(wanted, done)}
    table = df.sparkSession.createDataFrame(
        results, "model string, params string, cv_score double, test_f1_macro double"
    )
    winner = min(results, key=lambda r: (-r[3], r[0]))[0]
    return {"results": table, "models": models, "best": winner, "test": test}


def train_model(df: DataFrame, key: str, returns: str, kind: str = "classifier", lasso_config=None, class_config=None):
    """Train ``lasso``, ``classifier`` or ``all``, each with its own settings."""
    if kind not in ("lasso", "classifier", "all"):
        raise ValueError(f"unknown model type: {kind}")
    results = {}
    if kind in ("lasso", "all"):
        results["lasso"] = train_lasso(df, key, returns, **(lasso_config or {}))
    if kind in ("classifier", "all"):
        results["classifier"] = train_classifiers(df, key, returns, **(class_config or {}))
    return results
