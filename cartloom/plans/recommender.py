"""From the three tables to five products per session."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.operators import candidates as C
from cartloom.operators import interactions as I
from cartloom.operators import sessions as S
from cartloom.operators.evaluate import recommend, recommendation_lists
from cartloom.operators.folds import downsample_negatives, session_holdout, sessions_with_min_adds
from cartloom.operators.products import (
    impute_embeddings, impute_section, normalize_embedding, product_statistics, product_universe, restrict_products,
)
from cartloom.operators import boosting
from cartloom.operators.ranking import NDCG_RANKER, fit_ndcg_ranker, fit_ranker, score
from cartloom.operators.similarity import similar_lists, top_k_similar, top_similar_candidates
from cartloom.operators.users import dedupe_users, user_features
from cartloom.session import stage


@dataclass(frozen=True)
class Options:
    """How many candidates of each kind, and how the ranker is trained."""

    top_global: int | None = None
    top_country: int = 5
    top_user: int = 5
    top_similar: int = 5
    dedupe: str = "item"
    order: str = "by_time"
    strict_prior: bool = True
    carry_forward: bool = True
    min_adds: int = 5
    negative_ratio: float | None = None
    holdout: float = 0.1
    seed: int = 23
    ranker: dict = field(default_factory=dict)


# Feature tables without the corrections: see the README on the options.
PARITY = Options(
    top_global=10, dedupe="row", order="latest_first", strict_prior=False, carry_forward=False
)


def split_features(train: DataFrame, test: DataFrame, options: Options) -> DataFrame:
    """Both splits in one frame (`flag` 1/0) with everything that does not depend on candidates.

    Sessions do not span the splits, so one pass serves both.
    """
    train_rows, test_rows = I.impute_interactions(train), I.impute_interactions(test)
    plain = I.join_splits(train_rows, test_rows)
    both = I.running_counts(plain, strict_prior=options.strict_prior, carry_forward=options.carry_forward)
    rows = I.fill_zero(I.with_cart_ratios(both, I.cart_ratio_tables(train_rows)))
    return S.calendar_features(S.session_row_features(rows))


def train_features(both: DataFrame, options: Options) -> DataFrame:
    """Train rows of a written `split_features` frame, complete but for product and user columns."""
    train = both.filter(F.col("flag") == 1).drop("flag")
    return S.mask_unknown_users(S.product_touch_index(train))


def extended_test(both: DataFrame, train_fe: DataFrame, similar: DataFrame, options: Options) -> DataFrame:
    """Test rows of a written `split_features` frame with candidates from all sources."""
    return C.extend_test(
        both.filter(F.col("flag") == 0).drop("flag", "add_to_cart"),
        dedupe=options.dedupe,
        top_global=C.global_candidates(train_fe, options.top_global) if options.top_global else None,
        by_country=C.country_candidates(train_fe, options.top_country) if options.top_country else None,
        by_user=C.known_user_candidates(train_fe, options.top_user) if options.top_user else None,
        similar=similar if options.top_similar else None,
    )


def test_features(both: DataFrame, train_fe: DataFrame, similar: DataFrame, options: Options) -> DataFrame:
    """Extended test rows, filled and finished. Written once in between, as the last step reads them twice."""
    filled = stage(C.fill_candidates(extended_test(both, train_fe, similar, options)), "test_rows")
    return C.finish_test(filled, order=options.order)


@dataclass(frozen=True)
class Tables:
    train: DataFrame
    test: DataFrame
    users: DataFrame
    products: DataFrame


def build_tables(
    train: DataFrame, test: DataFrame, users: DataFrame, products: DataFrame, options: Options = Options()
) -> Tables:
    """Engineered train, test, users and products. Each reused step is written once to the shared folder."""
    wanted = restrict_products(products, product_universe(train, test))
    # Sections and family columns are worked out without the wide vectors, which are joined once, by product.
    filled = stage(impute_embeddings(wanted.select("partnumber", "family", "embedding")), "products_filled")
    slim = product_statistics(impute_section(wanted.drop("embedding")))
    products_fe = stage(slim.join(normalize_embedding(filled.drop("family")), "partnumber"), "products_fe")
    near = stage(similar_lists(top_k_similar(filled, 10)), "similar")
    similar = top_similar_candidates(near, options.top_similar)
    users_fe = stage(user_features(stage(dedupe_users(users), "users_one")), "users_fe")
    both = stage(split_features(train, test, options), "rows")
    train_fe = stage(train_features(both, options), "train_rows")
    test_fe = test_features(both, train_fe, similar, options)
    return Tables(
        stage(I.assemble_features(train_fe, products_fe, users_fe), "train_fe"),
        stage(I.assemble_features(test_fe, products_fe, users_fe), "test_fe"),
        users_fe, products_fe,
    )


def train_ranker(train_fe: DataFrame, options: Options = Options()) -> tuple[PipelineModel, DataFrame]:
    """The fitted ranker and the scored held-out sessions."""
    chosen = sessions_with_min_adds(train_fe, options.min_adds)
    fit_on, held = session_holdout(chosen, options.holdout, options.seed)
    fit_on = downsample_negatives(fit_on, options.negative_ratio, seed=options.seed)
    model = fit_ranker(fit_on, held, seed=options.seed, **options.ranker)
    return model, score(held, model)


def recommendations(test_fe: DataFrame, model: PipelineModel, k: int = 5) -> DataFrame:
    """(session_id, items): the k best products of each session."""
    return recommendation_lists(recommend(score(test_fe, model), k))


def train_ndcg_ranker(train_fe: DataFrame, options: Options = Options(), settings: boosting.Settings = NDCG_RANKER) -> boosting.Model:
    """Trees fitted to NDCG@5 on the sessions with enough adds; some of these sessions decide when to stop."""
    chosen = downsample_negatives(sessions_with_min_adds(train_fe, options.min_adds), options.negative_ratio, seed=options.seed)
    return fit_ndcg_ranker(stage(chosen, "ranker_rows"), settings, seed=options.seed)


def ranked(test_fe: DataFrame, model: boosting.Model, k: int = 5) -> DataFrame:
    """(session_id, rank, partnumber, score): the k best products of each session."""
    return recommend(boosting.predict_all(test_fe, [model], ["score"], ["session_id", "partnumber"]), k)
