"""Model matrix, ranker and classifier on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.functions.hashing import draw, draw_number
from cartloom.operators import boosting
from cartloom.operators.evaluate import ndcg_at_k, pooled_f1
from cartloom.operators.folds import group_folds, sample_sessions, session_holdout
from cartloom.session import stage

# The columns of the model matrix.
FEATURES = (
    "pagetype", "known_user", "device_type", "country",
    "page_cart_ratio", "device_cart_ratio", "country_cart_ratio",
    "user_previous_cart_additions", "user_previous_interactions",
    "seconds_since_last_interaction", "total_session_time", "interaction_length",
    "day_number", "weekday_number", "hour", "day_frame",
    "total_session_interactions", "product_interaction_count",
    "discount", "color_id", "cod_section", "family",
    "color_family_frequency", "family_discount_rate", "section_discount_rate", "family_unique_colors",
    "user_country", "R", "F", "M",
    "avg_value_per_purchase", "purchase_rate", "spend_rate_per_day",
    "total_value_frequency", "avg_days_between_purchases",
    "country_avg_monetary", "country_avg_frequency", "country_avg_recency",
    "relative_monetary_value", "relative_frequency", "relative_recency",
    "is_high_value_incountry", "is_frequent_buyer_incountry", "is_recent_customer_incountry",
    "is_high_value", "is_frequent_buyer", "is_recent_customer",
    "r_segment", "f_segment", "m_segment",
    "r_rank_in_country", "f_rank_in_country", "m_rank_in_country",
)

# Trees of Spark ML take no nulls: nulls become -1 and these columns say what was missing.
MISSING = {"user_missing": "user_country", "product_missing": "family", "section_missing": "cod_section"}


def model_columns(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """All features as doubles without nulls, plus the missing flags; text columns stay text."""
    text = {name for name, kind in df.dtypes if kind == "string"}
    flags = {flag: F.col(c).isNull().cast("double") for flag, c in MISSING.items() if c in features}
    numbers = {c: F.coalesce(F.col(c).cast("double"), F.lit(-1.0)) for c in features if c not in text}
    return df.withColumns(flags).withColumns(numbers)


def matrix_stages(df: DataFrame, features: Sequence[str] = FEATURES) -> list:
    """Indexer for each text column, then one assembler over all features and flags."""
    text = [c for c in features if dict(df.dtypes)[c] == "string"]
    indexers = [
        StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep", stringOrderType="alphabetAsc")
        for c in text
    ]
    inputs = [f"{c}_index" if c in text else c for c in features]
    inputs += [flag for flag, c in MISSING.items() if c in features]
    return [*indexers, VectorAssembler(inputCols=inputs, outputCol="features")]


def feature_vector(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """`df` with the model matrix as the vector column `features`."""
    ready = model_columns(df, features)
    return Pipeline(stages=matrix_stages(ready, features)).fit(ready).transform(ready)


def feature_names(model: PipelineModel) -> list[str]:
    return next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()


def fit_boosted(
    train: DataFrame,
    valid: DataFrame | None = None,
    *,
    features: Sequence[str] = FEATURES,
    rounds: int = 1000,
    balance_sessions: bool = False,
    seed: int = 23,
    **params,
) -> PipelineModel:
    """Gradient-boosted trees for `add_to_cart`; with `valid`, boosting stops when it gains nothing.

    `balance_sessions` gives every session the same total weight, as a mean over sessions does.
    """
    marked = train.withColumn("_held", F.lit(False))
    if valid is not None:
        marked = marked.unionByName(valid.withColumn("_held", F.lit(True)), allowMissingColumns=True)
    ready = model_columns(marked, features).withColumn("label", F.col("add_to_cart").cast("double"))
    if balance_sessions:
        sizes = ready.groupBy("session_id").agg((F.lit(1.0) / F.count(F.lit(1))).alias("_weight"))
        ready = ready.join(sizes, "session_id")
        params["weightCol"] = "_weight"
    if valid is not None:
        params["validationIndicatorCol"] = "_held"
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=rounds, seed=seed, **params)
    stages = matrix_stages(ready, features)
    needed = [*dict.fromkeys([*features, *MISSING, "label", "_held", *(["_weight"] if balance_sessions else [])])]
    # Written once: indexers, metadata, split points and the trees' rows each read it, and none repeats the joins before it.
    written = stage(ready.select(*[c for c in needed if c in ready.columns]), "fit_rows")
    return Pipeline(stages=[*stages, trees]).fit(written)


# Learning rate, leaves (2^5), rows per leaf, feature and row share of the ranker.
RANKER = {
    "stepSize": 0.05, "maxDepth": 5, "minInstancesPerNode": 20,
    "featureSubsetStrategy": "0.8", "subsamplingRate": 0.8,
}


# Share of the sessions of a fold's rest that early stopping watches.
STOPPING_SHARE = 0.1


def fit_ranker(train: DataFrame, valid: DataFrame | None = None, **options) -> PipelineModel:
    """Ranker for the products of a session: session-balanced boosted trees on relevance.

    Judged by NDCG on held-out sessions. No pairs of rows are formed, so a huge session is no
    heavier than its rows.
    """
    return fit_boosted(train, valid, balance_sessions=True, **{**RANKER, **options})


def fit_classifier(train: DataFrame, valid: DataFrame | None = None, *, rounds: int = 200, **options) -> PipelineModel:
    """Binary classifier for cart additions."""
    return fit_boosted(train, valid, rounds=rounds, **options)


def score(df: DataFrame, model: PipelineModel, features: Sequence[str] = FEATURES) -> DataFrame:
    """`df` with `score` (probability of an add) and the 0/1 `prediction`."""
    kept = [c for c in ("session_id", "partnumber", "interaction_id", "add_to_cart") if c in df.columns]
    scored = model.transform(model_columns(df, features))
    return scored.select(*kept, vector_to_array("probability")[1].alias("score"), "prediction")


def feature_importance(model: PipelineModel, spark) -> DataFrame:
    """(feature, importance), one row per model column."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(feature_names(model), weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )


def cross_validate(
    df: DataFrame,
    fit: Callable[[DataFrame], PipelineModel],
    measure: Callable[[DataFrame], DataFrame],
    folds: Sequence[int],
    features: Sequence[str] = FEATURES,
) -> DataFrame:
    """(fold, train, valid): `measure` of a model fitted without the fold, on the others and on it.

    `measure` turns scored rows into one row with one number. `df` has the column `fold`.
    """
    out = None
    for fold in folds:
        rest, held = df.filter(F.col("fold") != fold), df.filter(F.col("fold") == fold)
        model = fit(rest)
        row = (
            measure(score(rest, model, features)).toDF("train")
            .withColumn("valid", measure(score(held, model, features)).toDF("valid").scalar())
            .select(F.lit(fold).alias("fold"), "train", "valid")
        )
        out = row if out is None else out.unionByName(row)
    return out


def cross_validate_ranker(
    df: DataFrame, k: int = 5, *, share: float | None = None, seed: int = 23,
    features: Sequence[str] = FEATURES, **options,
) -> DataFrame:
    """NDCG@5 by session folds, on a random `share` of the sessions if one is given.

    Each fit stops early on some of its own sessions, never on the fold it is judged by.
    """
    if share is not None:
        df = df.join(sample_sessions(df, share, seed), "session_id", "left_semi")
    return cross_validate(
        group_folds(df, k, seed),
        lambda part: fit_ranker(*session_holdout(part, STOPPING_SHARE, seed), features=features, **options),
        lambda scored: ndcg_at_k(scored).select("ndcg"),
        range(k), features,
    )


def cross_validate_classifier(df: DataFrame, folds: Sequence[int], *, features: Sequence[str] = FEATURES, **options) -> DataFrame:
    """F1 of the positive class; `df` has the column `fold`."""
    return cross_validate(
        df,
        lambda part: fit_classifier(*session_holdout(part, STOPPING_SHARE), features=features, **options),
        lambda scored: pooled_f1(scored).select("f1"),
        folds, features,
    )


# Places that count, leaves, rows per leaf, learning rate, feature and row share, rounds without a gain.
NDCG_RANKER = boosting.Settings(rate=0.05, leaves=31, least_rows=20, feature_share=0.8, row_share=0.8, k=5, patience=10)


def _watched(seed: int) -> Column:
    """Sessions that early stopping watches, by the session id alone."""
    return draw_number(draw("session_id", seed=seed + 1)) < int(STOPPING_SHARE * 2**32)


def fit_ndcg_ranker(
    train: DataFrame, settings: boosting.Settings = NDCG_RANKER, *, features: Sequence[str] = FEATURES, seed: int = 23
) -> boosting.Model:
    """Trees fitted to the gradients of NDCG@k, which a share of the sessions of `train` watches. Nulls need no stand-in."""
    bins = boosting.find_bins(train, features, settings.bins)
    role = F.when(_watched(seed), boosting.WATCH).otherwise(boosting.TRAIN)
    return boosting.boost(boosting.chunks(train, bins, [role], k=settings.k), bins, 1, settings)[0]


def cross_validate_ndcg(
    df: DataFrame, k: int = 5, settings: boosting.Settings = NDCG_RANKER, *, features: Sequence[str] = FEATURES, seed: int = 23
) -> DataFrame:
    """(fold, rounds, train, valid): NDCG of models of one objective by session folds, all fitted in the same passes.

    Each model stops early on some of its own sessions, never on the fold it is judged by.
    """
    folded = group_folds(df, k, seed)
    bins = boosting.find_bins(folded, features, settings.bins)
    roles = [F.when(F.col("fold") == m, boosting.HELD).when(_watched(seed), boosting.WATCH).otherwise(boosting.TRAIN) for m in range(k)]
    models = boosting.boost(boosting.chunks(folded, bins, roles, k=settings.k), bins, k, settings)
    # Every row is scored once by all models, and all are judged in one pass.
    scores = [f"_score{m}" for m in range(k)]
    scored = stage(boosting.predict_all(folded, models, scores, ["session_id", "fold", "add_to_cart"]), "fold_scores")
    each = scored.repartition("session_id").select("session_id", "fold", "add_to_cart", F.posexplode(F.array(*scores)).alias("_model", "score"))
    judged = ndcg_at_k(each.withColumn("_held", F.col("fold") == F.col("_model")), settings.k, by=["_model", "_held"])
    sides = judged.groupBy(F.col("_model").alias("fold")).agg(
        F.max(F.when(~F.col("_held"), F.col("ndcg"))).alias("train"), F.max(F.when(F.col("_held"), F.col("ndcg"))).alias("valid")
    )
    rounds = df.sparkSession.createDataFrame([(fold, len(model.trees)) for fold, model in enumerate(models)], "fold int, rounds int")
    return rounds.join(sides, "fold", "left").select("fold", "rounds", "train", "valid")


def compare_objectives(df: DataFrame, k: int = 5, settings: boosting.Settings = NDCG_RANKER, **options) -> DataFrame:
    """(fold, pointwise, ranked): NDCG on held-out folds of trees fitted row by row and to NDCG, alike in everything else."""
    ranked = cross_validate_ndcg(df, k, replace(settings, objective="ndcg"), **options).select("fold", F.col("valid").alias("ranked"))
    pointwise = cross_validate_ndcg(df, k, replace(settings, objective="logistic"), **options).select("fold", F.col("valid").alias("pointwise"))
    return pointwise.join(ranked, "fold")
