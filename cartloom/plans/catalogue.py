"""Every operator as a named query over the given tables: (spark, folder) -> DataFrame.

Each entry states its output columns once; the same statement types the Spark result and the SQL
text of the same name. Kinds: i whole number (default), d number at six decimals, s text,
t timestamp, a date.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom import schemas
from cartloom.operators import (
    analytics as A, candidates as C, evaluate as E, folds as FO, interactions as I, products as P, profile as D,
    ranking as R, sampling as SA, sessions as S, similarity as V, sketches as SK, users as U,
)
from cartloom.plans import oracle
from cartloom.plans import recommender as REC
from cartloom.session import new_path, stage
from cartloom.sources import fixtures, readers, writers
from cartloom.streaming import commits as CM

ITEMS = replace(REC.PARITY, dedupe="item")

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Data:
    """The model tables of one folder."""

    spark: SparkSession
    folder: str

    @property
    def interactions(self) -> DataFrame:
        return fixtures.interactions(self.spark, self.folder)

    @property
    def train(self) -> DataFrame:
        return fixtures.train(self.spark, self.folder)

    @property
    def test(self) -> DataFrame:
        return fixtures.test(self.spark, self.folder)

    @property
    def users(self) -> DataFrame:
        return fixtures.users(self.spark, self.folder)

    @property
    def products(self) -> DataFrame:
        return fixtures.products(self.spark, self.folder)

    @property
    def one_user(self) -> DataFrame:
        return U.dedupe_users(self.users)

    @property
    def rows(self) -> DataFrame:
        """Both splits with all columns that do not depend on candidates, written once."""
        return stage(REC.split_features(self.train, self.test, REC.PARITY), "rows")

    @property
    def near(self) -> DataFrame:
        """Five nearest products, among the products of both splits."""
        own = P.restrict_products(self.products, P.product_universe(self.train, self.test))
        top = V.top_k_similar(stage(own.select("partnumber", "embedding"), "own"), 10)
        return V.top_similar_candidates(V.similar_lists(top), 5)

    def sources(self, options: REC.Options) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Rows of both splits, train features and near products, each written once."""
        rows = self.rows
        return rows, stage(REC.train_features(rows, options), "train_rows"), stage(self.near, "near")

    def extended(self, options: REC.Options = REC.PARITY) -> DataFrame:
        return REC.extended_test(*self.sources(options), options)

    def finished(self, order: str) -> DataFrame:
        options = replace(REC.PARITY, order=order)
        return REC.test_features(*self.sources(options), options)

    @property
    def popularity(self) -> DataFrame:
        return self.train.groupBy("partnumber").agg(
            F.count("add_to_cart").alias("score"), F.sum("add_to_cart").alias("adds")
        )

    @property
    def scored(self) -> DataFrame:
        """Train rows scored by how often their product is seen."""
        guess = (F.col("adds") * 5 >= F.col("score")).cast("int").alias("prediction")
        counts = self.popularity.select("partnumber", "score", guess)
        return self.train.join(counts, "partnumber")

    @property
    def top5(self) -> DataFrame:
        offered = self.extended(ITEMS).select("session_id", "partnumber")
        scored = offered.join(self.popularity.select("partnumber", "score"), "partnumber", "left")
        return E.recommend(scored.withColumn("score", F.coalesce("score", F.lit(0))))

    @property
    def user_records(self) -> DataFrame:
        """User entries folded into one nested record per user (at most one entry per order status)."""
        entry = F.struct("F", "M", "country", "R")
        folded = self.users.groupBy("user_id").agg(F.array_sort(F.collect_list(entry)).alias("e"))
        lists = F.struct(*[F.col(f"e.{c}").alias(c) for c in ("country", "R", "F", "M")])
        return folded.select(F.col("user_id").cast("string").alias("user_id"), lists.alias("values"))

    @property
    def model_rows(self) -> DataFrame:
        """Train rows with product and user columns."""
        products = P.product_statistics(P.impute_section(self.products))
        train_fe = REC.train_features(self.rows, REC.PARITY)
        return I.assemble_features(train_fe, products, U.user_features(stage(self.one_user, "users_one")))


_KINDS = {"i": "bigint", "s": "string", "t": "timestamp_ntz", "a": "date"}


def _typed(name: str, kind: str) -> Column:
    column = F.col(name)
    if kind == "d":
        return column.cast("decimal(38,6)").cast("double").alias(name)
    return column.cast(_KINDS[kind]).alias(name)


def _columns(text: str) -> list[tuple[str, str]]:
    return [(part.partition(":")[0], part.partition(":")[2] or "i") for part in text.split()]


_ENTRIES: dict[str, tuple[str, Callable[[Data], DataFrame]]] = {}


def entry(name: str, columns: str):
    def add(build: Callable[[Data], DataFrame]):
        _ENTRIES[name] = (columns, build)
        return build
    return add


def _add(name: str, columns: str, build: Callable[[Data], DataFrame]) -> None:
    _ENTRIES[name] = (columns, build)


# Column lists used more than once.
USER = "user_id user_country R F M:d"
RATIOS = ("avg_value_per_purchase:d purchase_rate:d spend_rate_per_day:d total_value_frequency:d "
          "avg_days_between_purchases:d")
COUNTRY = ("country_avg_monetary:d country_avg_frequency:d country_avg_recency:d relative_monetary_value:d "
           "relative_frequency:d relative_recency:d")
FLAGS = ("is_high_value_incountry is_frequent_buyer_incountry is_recent_customer_incountry is_high_value "
         "is_frequent_buyer is_recent_customer")
SEGMENTS = "r_segment f_segment m_segment"
RANKS = "r_rank_in_country f_rank_in_country m_rank_in_country"
IMPUTED = "interaction_id session_id timestamp_local:t user_id country partnumber device_type pagetype known_user"
CART = "page_cart_ratio:d device_cart_ratio:d country_cart_ratio:d"
RUNNING = "user_previous_cart_additions user_previous_interactions"
TIMES = "seconds_since_last_interaction:d total_session_time:d interaction_length:d"
CALENDAR = "day_number weekday_number hour day_frame"
ROW = f"{IMPUTED} {CART} {RUNNING} {TIMES} total_session_interactions {CALENDAR}"
PRODUCT = ("discount color_id cod_section:s family color_family_frequency family_discount_rate:d "
           "section_discount_rate:d family_unique_colors")
ONE_VALUE = "partnumber pos value:d"
JANUARY = ("2024-01-01", "2024-01-07")


def _values(df: DataFrame) -> DataFrame:
    return df.select("partnumber", F.posexplode("embedding").alias("pos", "value"))


# Analytic questions.
_add("q1_lowest_family_product", "partnumber", lambda d: A.lowest_family_product(d.products))
_add("q1_global_min_family", "partnumber", lambda d: A.lowest_family_product(d.products, strict_global_min=True))
_add("q1_sql_text", "partnumber", lambda d: A.lowest_family_product_sql(d.products))
_add("q2_least_frequent_user", "user_id", lambda d: A.least_frequent_user(d.users, 500_000))
_add("q2_distinct_users", "user_id", lambda d: A.least_frequent_user(d.users, 500_000, distinct_users=True))
_add("q3_avg_visits_before_add", "average_previous_visits:d", lambda d: A.avg_visits_before_add(d.train))
_add("q3_visits_per_added_group", "average_previous_visits:d",
     lambda d: A.avg_visits_before_add(d.train, grain="session_product"))
_add("q4_device_counts", "device_type count", lambda d: A.device_counts(d.train, d.products))
_add("q4_top_device", "device_type", lambda d: A.top_device_discounted_adds(d.train, d.products))
_add("q5_top_user", "user_id", lambda d: A.top_user_by_distinct_products(d.train, d.users))
_add("q5_top_frequency_users", "user_id country F rank_in_country", lambda d: A.top_frequency_users(d.users))
_add("q6_families_outside_home", "unique_families", lambda d: A.families_outside_home(d.train, d.users, d.products))
_add("q7_top_pagetype", "family pagetype", lambda d: A.top_pagetype_per_family(d.train, d.products, *JANUARY))


@entry("answers", "query:s key:s value:s")
def _answers(d: Data) -> DataFrame:
    return writers.answer_rows({
        "query_1": A.lowest_family_product(d.products),
        "query_2": A.least_frequent_user(d.users, 500_000),
        "query_3": A.avg_visits_before_add(d.train),
        "query_4": A.top_device_discounted_adds(d.train, d.products),
        "query_5": A.top_user_by_distinct_products(d.train, d.users),
        "query_6": A.families_outside_home(d.train, d.users, d.products),
        "query_7": A.top_pagetype_per_family(d.train, d.products, *JANUARY),
    })


METRICS = "user_id session_id total_session_time:d cart_addition_ratio:d"
_add("session_metrics", METRICS, lambda d: S.session_metrics(d.interactions))
_add("session_metrics_user", METRICS, lambda d: S.session_metrics(d.interactions, 7))

# Users.
_add("users_dedup", USER, lambda d: d.one_user)
_add("user_ratio_features", f"{USER} {RATIOS}", lambda d: U.user_ratio_features(d.one_user))
_add("user_country_features", f"{USER} {COUNTRY}", lambda d: U.user_country_features(d.one_user))
_add("user_flags", f"user_id {FLAGS}", lambda d: U.user_flags(d.one_user))
_add("rfm_ranks", f"user_id {RANKS}", lambda d: U.rfm_ranks(d.one_user))
_add("rfm_segments", f"user_id {SEGMENTS} {RANKS}", lambda d: U.rfm_segments(d.one_user))
_add("rfm_segments_by_country", f"user_id {SEGMENTS}", lambda d: U.rfm_segments(d.one_user, scope="country"))
_add("user_record_rows", "user_id country R F M:d", lambda d: readers.user_rows(d.user_records))
_add("user_record_recent", "user_id country R F M:d", lambda d: readers.recent_user_rows(d.user_records))

# Products.
_add("product_universe", "partnumber family color_id cod_section:s discount",
     lambda d: P.restrict_products(d.products, P.product_universe(d.train, d.test)))
_add("product_section_impute", "partnumber cod_section:s", lambda d: P.impute_section(d.products))
_add("product_embedding_impute", ONE_VALUE, lambda d: _values(P.impute_embeddings(d.products)))
_add("product_norm", ONE_VALUE, lambda d: _values(P.normalize_embedding(d.products)))
_add("product_features", f"partnumber {PRODUCT}", lambda d: P.product_statistics(P.impute_section(d.products)))

# Interactions and sessions.
_add("interactions_cast", "interaction_id session_id date:a timestamp_local:t user_id country partnumber device_type "
     "pagetype add_to_cart", lambda d: readers.cast_interactions(d.train))


@entry("interactions_imputed", f"{IMPUTED} flag add_to_cart")
def _imputed(d: Data) -> DataFrame:
    return I.join_splits(I.impute_interactions(d.train), I.impute_interactions(d.test))


@entry("cart_ratios", f"interaction_id flag {CART}")
def _cart_ratios(d: Data) -> DataFrame:
    return I.join_splits(*I.cart_ratios(I.impute_interactions(d.train), I.impute_interactions(d.test)))


@entry("user_running_counts", f"interaction_id flag {RUNNING}")
def _running(d: Data) -> DataFrame:
    return I.join_splits(*I.user_running_counts(I.impute_interactions(d.train), I.impute_interactions(d.test)))


@entry("user_running_counts_strict", f"interaction_id {RUNNING}")
def _running_strict(d: Data) -> DataFrame:
    return I.running_counts(_imputed(d), strict_prior=True, carry_forward=True)


_add("session_time_features", f"interaction_id session_id {TIMES}", lambda d: S.session_time_features(d.train))
_add("calendar_features", f"interaction_id {CALENDAR}", lambda d: S.calendar_features(d.train))
_add("timestamps_parsed", "interaction_id timestamp_local:t", lambda d: S.with_timestamps(
    d.train.withColumn("timestamp_local", F.date_format("timestamp_local", "yyyy-MM-dd HH:mm:ss.SSSSSS"))))
_add("session_size", "interaction_id total_session_interactions", lambda d: S.session_size(d.train))
_add("product_touch_index", "interaction_id product_interaction_count", lambda d: S.product_touch_index(d.train))
_add("train_features", f"{ROW} add_to_cart product_interaction_count", lambda d: REC.train_features(d.rows, REC.PARITY))
_add("assembled_train", f"interaction_id session_id partnumber add_to_cart {ROW.partition('partnumber ')[2]} "
     f"product_interaction_count {PRODUCT} {USER.partition(' ')[2]} {RATIOS} {COUNTRY} {FLAGS} {SEGMENTS} {RANKS}",
     lambda d: d.model_rows)
_add("feature_matrix", "interaction_id pos value:d",
     lambda d: R.feature_vector(d.model_rows).select("interaction_id", F.posexplode(R.vector_to_array("features")).alias("pos", "value")))

# Similarity.
_add("top_k_similar", "partnumber rank neighbour cosine:d",
     lambda d: V.top_k_similar(stage(P.impute_embeddings(d.products).select("partnumber", "embedding"), "filled")))


@entry("top_k_lsh_recall", "pairs found recall:d")
def _lsh_recall(d: Data) -> DataFrame:
    filled = stage(P.impute_embeddings(d.products).select("partnumber", "embedding"), "filled")
    return V.top_k_recall(V.top_k_lists(filled), V.top_k_lists_lsh(filled))


@entry("top_k_index_recall", "pairs found recall:d exact_products all_products")
def _index_recall(d: Data) -> DataFrame:
    return V.index_report(stage(P.impute_embeddings(d.products).select("partnumber", "embedding"), "filled"))


_add("top_k_work", "vectors blocks sent all_blocks", lambda d: V.search_work(d.products))
_add("similar_exploded", "partnumber neighbour synthetic_candidate", lambda d: d.near)
_add("cosine_pairs", "partnumber_a partnumber_b cosine:d copies_a copies_b", lambda d: V.cosine_pairs(d.products, 0.3))
_add("pca_explained", "threshold:d components", lambda d: V.pca_explained(d.products))

# Candidates.
_add("cand_global", "partnumber score", lambda d: C.global_candidates(d.train, 10))
_add("cand_country", "country partnumber total_add_to_cart", lambda d: C.country_candidates(d.train, 5))
_add("cand_known_user", "user_id partnumber product_interaction_count interaction_length:d rank",
     lambda d: C.known_user_candidates(REC.train_features(d.rows, REC.PARITY), 5))
_add("cand_similar", "session_id partnumber",
     lambda d: C.similar_candidates(d.test, d.near).distinct())
_add("test_extended", f"{ROW} synthetic_candidate", lambda d: d.extended())
_add("test_extended_items", "session_id partnumber country user_id sources:s",
     lambda d: d.extended(ITEMS).filter(F.col("synthetic_candidate") == 1)
     .withColumn("sources", F.array_join("sources", ",")))
_add("candidates_filled", f"{ROW} synthetic_candidate", lambda d: C.fill_candidates(d.extended()))


@entry("fill_session_nulls", f"interaction_id session_id partnumber {CART} {RUNNING} known_user total_session_interactions")
def _fill_nulls(d: Data) -> DataFrame:
    return S.fill_session_nulls(d.extended())


_add("test_features", f"{ROW} synthetic_candidate product_interaction_count", lambda d: d.finished("latest_first"))
_add("test_touch_index_by_time", f"{ROW} synthetic_candidate product_interaction_count",
     lambda d: d.finished("by_time"))

# Learning and evaluation.
TRAIN = ("interaction_id session_id date:a timestamp_local:t user_id country partnumber device_type pagetype "
         "add_to_cart")
# Sources and sinks, over tables written to the shared folder.
def _written(df: DataFrame, kind: str) -> str:
    path = new_path(df.sparkSession, kind)
    if kind == "csv":
        df.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    else:
        writers.write_table(df, path)
    return path


@entry("csv_round_trip", TRAIN)
def _csv_round_trip(d: Data) -> DataFrame:
    return readers.load_data(d.spark, _written(d.train, "csv"), d.train.schema)


_add("parquet_projection", "session_id partnumber", lambda d: readers.load_data(
    d.spark, _written(d.train, "parquet"), file_type="parquet", select_cols=["session_id", "partnumber"]))
def _bucketed(d: Data, df: DataFrame) -> DataFrame:
    path = new_path(d.spark, "bucketed")
    name = path.rpartition("/")[2].replace("-", "_")
    return writers.write_bucketed(df, name, path, order=["timestamp_local", "interaction_id"], buckets=16)


_add("session_size_bucketed", "interaction_id total_session_interactions", lambda d: S.session_size(_bucketed(d, d.train)))
_add("merged_batches", "user_id country R F M:d", lambda d: readers.merge_batches(d.spark, _written(d.users, "parquet")))


@entry("session_metrics_streamed", METRICS)
def _streamed(d: Data) -> DataFrame:
    """The batch metrics from a stream over files that come in no order of time, several batches of them."""
    rows = d.interactions.select(*schemas.INTERACTIONS.names)
    source = _written(rows.repartition(12), "parquet")
    return CM.session_metrics_so_far(d.spark, source, new_path(d.spark, "sums"), new_path(d.spark, "sums-state"), files_per_batch=5)


@entry("merged_batches_incremental", "user_id country R F M:d")
def _merged_new(d: Data) -> DataFrame:
    """User batches merged as they come: two calls, the second with files that the first has not seen."""
    source, table, state = (new_path(d.spark, n) for n in ("user-batches", "users", "users-state"))
    early = F.pmod(F.xxhash64("user_id"), F.lit(2)) == 0
    writers.write_table(d.users.filter(early), source)
    CM.merge_new_users(d.spark, source, table, state)
    d.users.filter(~early).write.mode("append").parquet(source)
    return CM.merge_new_users(d.spark, source, table, state, files_per_batch=3)


_add("sessions_min_adds", TRAIN, lambda d: FO.sessions_with_min_adds(d.train, 5))
_add("downsample", "interaction_id add_to_cart", lambda d: FO.downsample_negatives(d.train, 1.5))
_add("random_rows", "interaction_id partnumber", lambda d: SA.sample_rows(d.train, 500, ["interaction_id"]))
_add("first_rows", "interaction_id partnumber", lambda d: SA.first_rows(d.train, 500, ["interaction_id"]))


@entry("session_holdout", "session_id held")
def _holdout(d: Data) -> DataFrame:
    rest, held = FO.session_holdout(d.train, 0.1)
    return rest.select("session_id", F.lit(0).alias("held")).union(
        held.select("session_id", F.lit(1).alias("held"))
    ).distinct()


_add("group_folds", "interaction_id fold", lambda d: FO.group_folds(d.train))
_add("strat_folds", "session_id adds fold", lambda d: FO.stratified_session_folds(d.train))
_add("group_sizes", "session_id rows", lambda d: FO.group_sizes(d.train))
_add("session_ndcg", "session_id ndcg:d", lambda d: E.session_ndcg(d.scored))
_add("ndcg_at_5", "ndcg:d sessions", lambda d: E.ndcg_at_k(d.scored))
_add("f1_score", "tp fp fn f1:d", lambda d: E.pooled_f1(d.scored))
_add("recommend_top5", "session_id rank partnumber score", lambda d: d.top5)
_add("recommendation_json", "value:s", lambda d: writers.recommendation_json(E.recommendation_lists(d.top5)))

def _ranker(d: Data):
    rows = stage(d.model_rows, "model_rows")
    fit_on, held = FO.session_holdout(FO.sessions_with_min_adds(rows, 1), 0.1)
    return R.fit_ranker(fit_on, held), rows


@entry("ranker_scores", "session_id interaction_id score:d prediction")
def _ranker_scores(d: Data) -> DataFrame:
    model, rows = _ranker(d)
    return R.score(rows, model)


@entry("ranker_importance", "feature:s importance:d")
def _importance(d: Data) -> DataFrame:
    return R.feature_importance(_ranker(d)[0], d.spark)


@entry("ranker_folds_ndcg", "fold train:d valid:d")
def _ranker_folds(d: Data) -> DataFrame:
    return R.cross_validate_ranker(stage(d.model_rows, "model_rows"))


@entry("classifier_folds_f1", "fold train:d valid:d")
def _classifier_folds(d: Data) -> DataFrame:
    rows = stage(FO.stratified_group_folds(d.model_rows, 5), "model_rows")
    return R.cross_validate_classifier(rows, range(5))


@entry("ranker_ndcg_folds", "fold rounds train:d valid:d")
def _ndcg_folds(d: Data) -> DataFrame:
    return R.cross_validate_ndcg(stage(d.model_rows, "model_rows"))


@entry("recommend_ranked", "session_id rank partnumber score:d")
def _recommend_ranked(d: Data) -> DataFrame:
    """From the tables to five products per test session, in the order of a ranker trained on the train sessions."""
    options = REC.Options(min_adds=1)
    tables = REC.build_tables(d.train, d.test, d.users, d.products, options)
    return REC.ranked(tables.test, REC.train_ndcg_ranker(tables.train, options))


# Profiles.
_add("null_counts", "column_name:s nulls", lambda d: D.null_counts(d.train))
_add("distinct_counts", "column_name:s distinct_values", lambda d: D.distinct_counts(d.train))
KEYS = ("session_id", "user_id", "partnumber")


@entry("distinct_estimates", "column_name:s distinct_values estimate error:d bound:d")
def _estimates(d: Data) -> DataFrame:
    """Sketches by day, merged, beside the exact counts."""
    by_day = SK.column_sketches(d.train, [f for f in d.train.columns if f != "date"], ["date"])
    exact = D.distinct_counts(d.train.drop("date"))
    both = exact.join(SK.distinct_estimates(SK.merged(by_day)), "column_name")
    return both.withColumns({
        "error": F.abs(F.col("estimate") - F.col("distinct_values")) / F.col("distinct_values"), "bound": F.lit(SK.relative_bound()),
    })


@entry("overlap_estimates", "column_name:s common train_only test_only either")
def _overlaps(d: Data) -> DataFrame:
    return SK.overlap_estimates(SK.column_sketches(d.train, KEYS), SK.column_sketches(d.test, KEYS))


_add("split_overview", "split:s sessions products first_date:a last_date:a", lambda d: D.split_overview(d.train, d.test))
_add("key_overlap", "partnumber found_in:s", lambda d: D.key_overlap(d.train, d.test, "partnumber"))
_add("common_keys", "user_id", lambda d: D.common_keys(d.train, d.test, "user_id"))
_add("test_only_keys", "session_id", lambda d: D.test_only_keys(d.train, d.test, "session_id"))
_add("long_sessions", "session_id rows", lambda d: D.long_sessions(d.train, 5))
_add("label_distribution", "add_to_cart rows share:d negative_ratio:d", lambda d: D.label_distribution(d.train))
_add("popularity_histogram", "bin low:d high:d n",
     lambda d: D.popularity_histogram(d.popularity, 5, 20))
_add("users_per_session", "users sessions", lambda d: D.users_per_session(d.train))
_add("numeric_summary", "column_name:s count mean:d std:d min:d q25:d q50:d q75:d max:d", lambda d: D.numeric_summary(d.train))


def _query(name: str) -> Query:
    columns, build = _ENTRIES[name]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Data(spark, folder)).select(*[_typed(*c) for c in _columns(columns)])

    return run


def queries() -> dict[str, Query]:
    return {name: _query(name) for name in _ENTRIES}


def oracle_sql() -> dict[str, str]:
    return {
        name: oracle.statement(parts, _columns(_ENTRIES[name][0]), body)
        for name, (parts, body) in oracle.BODIES.items()
    }
