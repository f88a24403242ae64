"""Spark ML models and their scores.

Estimators are Spark ML (distributed training over the partitions);
scores are evaluator or SQL aggregates over the scored frame. Holdout
splits hash a row key (``xxhash64`` with the seed), so a row lands in the
same set whatever the partitioning, unlike ``randomSplit``. Only model
metadata (feature weights, principal axes: a handful of numbers) ever
reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import (IDF, PCA, HashingTF, RegexTokenizer, SQLTransformer, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.functions.semantics import np_round, safe_div
from postlens.operators import deep_forest, isolation, linear, retrieval
from postlens.operators.quantiles import exact_quantiles
from postlens.session import kept
from postlens.sources.tables import broadcast_if_rows_at_most

SEED = 42


# ---------------------------------------------------------------- shared pieces
def holdout_flag(*keys: str, test_fraction: float = 0.2, seed: int = SEED) -> Column:
    """True for the test set: a stable digest of the row key, independent of
    partitioning and of the order rows arrive in (``holdout_sql`` in SQL)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    h = F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long") % 10000
    return h < F.lit(int(round(test_fraction * 10000)))


def holdout_sql(*keys: str, test_fraction: float = 0.2, seed: int = SEED) -> str:
    """``holdout_flag`` for the SQL twin."""
    text = " || '|' || ".join([f"'{seed}'", *(f"coalesce(cast({k} AS string), '')" for k in keys)])
    return f"cast('0x' || substring(md5({text}), 1, 7) AS BIGINT) % 10000 < {int(round(test_fraction * 10000))}"


def label_encoder(col: str) -> StringIndexer:
    """Category -> code, classes sorted ascending (``LabelEncoder``);
    unseen categories get the extra code instead of failing."""
    return StringIndexer(inputCol=col, outputCol=f"{col}_encoded", stringOrderType="alphabetAsc",
                         handleInvalid="keep")


def regression_scores(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """MAE, RMSE and R² of a scored frame, in one aggregate."""
    err = F.col(prediction) - F.col(label)
    ss_tot = F.var_pop(label) * F.count(F.lit(1))
    return pred.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.lit(1.0) - safe_div(F.sum(err * err), ss_tot)).alias("r2"))


def classification_scores(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Accuracy, and precision / recall / F1 of the positive class (1)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    tp, fp, fn = F.count_if((p == 1) & (y == 1)), F.count_if((p == 1) & (y == 0)), F.count_if((p == 0) & (y == 1))
    s = pred.agg(F.count(F.lit(1)).alias("n"), safe_div(F.count_if(p == y), F.count(F.lit(1))).alias("accuracy"),
                 safe_div(tp, tp + fp).alias("precision"), safe_div(tp, tp + fn).alias("recall"))
    return s.withColumn("f1", safe_div(F.col("precision") * F.col("recall") * 2.0,
                                       F.col("precision") + F.col("recall")))


# ---------------------------------------------------------------- delivery time
DELIVERY_FEATURES = ["city_encoded", "parcel_type_encoded", "hour"]


def delivery_frame(deliveries: DataFrame) -> DataFrame:
    """Model columns of the deliveries; a frame of them stays as it is."""
    if "is_test" in deliveries.columns:
        return deliveries
    return deliveries.select("delivery_id", "city", "parcel_type", F.hour("receive_datetime").alias("hour"),
                             F.col("delivery_duration_minutes").cast("double").alias("label"),
                             holdout_flag("delivery_id", "parcel_id", "receive_datetime").alias("is_test"))


def kept_delivery_frame(deliveries: DataFrame) -> DataFrame:
    """``delivery_frame``, computed once: fit, scores and predictions pass
    over it about ten times, each of which would join and digest every row."""
    return deliveries if "is_test" in deliveries.columns else kept(delivery_frame(deliveries), "delivery-frame")


@dataclass
class DeliveryModel:
    """Label encoders and the forest on their codes."""

    encoders: PipelineModel
    forest: deep_forest.DeepForest

    def parts(self) -> dict:
        return {"encoders": self.encoders, "forest": self.forest}

    def transform(self, frame: DataFrame) -> DataFrame:
        return deep_forest.predict(self.encoders.transform(frame), self.forest)


def delivery_time_model(train: DataFrame, trees: int = deep_forest.TREES) -> DeliveryModel:
    """Random forest of 50 trees on city, parcel type and hour, grown to
    purity on all features at every split, as scikit-learn's default does."""
    encoders = Pipeline(stages=[label_encoder("city"), label_encoder("parcel_type")]).fit(train)
    return DeliveryModel(encoders, deep_forest.grow(encoders.transform(train), DELIVERY_FEATURES, "label", trees, SEED))


def _to_score(frame: DataFrame, every_row: bool) -> DataFrame:
    """The held-out rows, or all rows."""
    return frame if every_row else frame.where(F.col("is_test"))


def score_delivery_time(model: DeliveryModel, deliveries: DataFrame, every_row: bool = False) -> DataFrame:
    scored = model.transform(_to_score(delivery_frame(deliveries), every_row))
    return scored.select("delivery_id", "city", "parcel_type", "hour", F.col("label").alias("actual_minutes"), F.col("prediction").alias("predicted_minutes"))


def fit_delivery_time(deliveries: DataFrame, every_row: bool = False) -> tuple[DeliveryModel, DataFrame]:
    frame = kept_delivery_frame(deliveries)
    model = delivery_time_model(frame.where(~F.col("is_test")))
    return model, score_delivery_time(model, frame, every_row)


def accuracy_within_minutes(scored: DataFrame, bounds=(10, 15, 20, 30)) -> DataFrame:
    err = F.abs(F.col("predicted_minutes") - F.col("actual_minutes"))
    return scored.agg(*[F.avg((err <= b).cast("double")).alias(f"within_{b}_minutes") for b in bounds])


def feature_importance(spark: SparkSession, model: DeliveryModel, names: list[str]) -> DataFrame:
    """Feature -> weight rows from the fitted forest (one number per feature)."""
    weights = model.forest.importance
    return spark.createDataFrame([(n, float(w)) for n, w in zip(names, weights)], "feature string, importance double")


# ---------------------------------------------------------------- satisfaction
SATISFACTION_FEATURES = ["city_encoded", "delivery_type_encoded", "delivery_delay", "delivery_time_actual"]


def satisfaction_frame(feedback: DataFrame) -> DataFrame:
    """Model columns of the feedback; a frame of them stays as it is."""
    if "is_test" in feedback.columns:
        return feedback
    return feedback.select("feedback_id", "city", "delivery_type",
                           (F.col("delivery_time_actual") - F.col("delivery_time_promised")).cast("double").alias("delivery_delay"),
                           F.col("delivery_time_actual").cast("double").alias("delivery_time_actual"),
                           (F.col("satisfaction_score") >= 7).cast("double").alias("label"), holdout_flag("feedback_id").alias("is_test"))


def fit_satisfaction(feedback: DataFrame, every_row: bool = False) -> tuple[PipelineModel, DataFrame]:
    """Logistic regression on city, delivery type, delay and actual time ->
    satisfied (score >= 7), by Newton steps over summed Hessians. As in
    scikit-learn with C = 1, half the squared weights are the penalty and the
    intercept has none. Features are set against their training means, which
    changes the intercept only. The model is a pipeline of the two encoders
    and one SQL expression of the weights, so it is saved like any other."""
    f = kept(satisfaction_frame(feedback), "satisfaction-frame")  # a pass for each encoder and Newton step
    train = f.where(~F.col("is_test"))
    encoders = Pipeline(stages=[label_encoder("city"), label_encoder("delivery_type")]).fit(train)
    coded = kept(encoders.transform(train).select(*SATISFACTION_FEATURES, "label"), "satisfaction-codes")
    means = coded.agg(*[F.avg(c) for c in SATISFACTION_FEATURES]).first()
    means = [float(m) if m is not None else 0.0 for m in means]
    xs = [F.lit(1.0), *[F.col(c) - m for c, m in zip(SATISFACTION_FEATURES, means)]]
    w = linear.newton_logistic(coded, xs, F.col("label"), [0.0] + [1.0] * len(SATISFACTION_FEATURES))
    terms = " + ".join([f"{float(w[0])!r}D", *(f"{float(v)!r}D * (`{c}` - {m!r}D)" for c, v, m in zip(SATISFACTION_FEATURES, w[1:], means))])
    score = SQLTransformer(statement=f"SELECT *, 1.0D / (1.0D + exp(-({terms}))) AS p_satisfied FROM __THIS__")
    chosen = SQLTransformer(statement="SELECT *, CASE WHEN p_satisfied > 0.5D THEN 1.0D ELSE 0.0D END AS prediction FROM __THIS__")
    model = PipelineModel(stages=[*encoders.stages, score, chosen])
    return model, score_satisfaction(model, f, every_row)


def score_satisfaction(model: PipelineModel, feedback: DataFrame, every_row: bool = False) -> DataFrame:
    return model.transform(_to_score(satisfaction_frame(feedback), every_row)).select("feedback_id", "label", "prediction", "p_satisfied")


# ---------------------------------------------------------------- customers
def customer_window_features(purchases: DataFrame, horizon_days: int) -> DataFrame:
    """Per customer, features from orders before the cutoff (last order
    date - horizon) and the outcome after it: spend after the cutoff and
    a churn label (no order after the cutoff). A frame of them stays as it is."""
    if "is_test" in purchases.columns:
        return purchases
    cutoff = purchases.agg(F.date_sub(F.max("order_date"), horizon_days)).scalar()
    before = F.col("order_date") <= cutoff
    g = purchases.groupBy("customer_id").agg(
        F.count_if(before).alias("orders_before"),
        F.sum(F.when(before, F.col("amount"))).alias("spend_before"),
        F.avg(F.when(before, F.col("amount"))).alias("aov_before"),
        F.max(F.when(before, F.col("order_date"))).alias("last_before"),
        F.min(F.when(before, F.col("order_date"))).alias("first_before"),
        F.coalesce(F.sum(F.when(~before, F.col("amount"))), F.lit(0.0)).alias("spend_after"),
        F.count_if(~before).alias("orders_after"))
    g = g.where(F.col("orders_before") > 0)
    return g.select("customer_id", F.col("orders_before").cast("double").alias("frequency"),
                    F.col("spend_before").alias("monetary"), F.col("aov_before").alias("avg_order_value"),
                    F.datediff(F.lit(cutoff), F.col("last_before")).cast("double").alias("recency_days"),
                    F.datediff(F.col("last_before"), F.col("first_before")).cast("double").alias("tenure_days"),
                    "spend_after", (F.col("orders_after") == 0).cast("double").alias("churned"),
                    holdout_flag("customer_id").alias("is_test"))


def kept_customers(purchases: DataFrame, horizon_days: int) -> DataFrame:
    """``customer_window_features``, computed once for the trees' passes and the scores."""
    return purchases if "is_test" in purchases.columns else kept(customer_window_features(purchases, horizon_days), "customer-windows")


CUSTOMER_FEATURES = ["frequency", "monetary", "avg_order_value", "recency_days", "tenure_days"]


LTV_DAYS, CHURN_DAYS = 365, 180


def ltv_model(purchases: DataFrame, horizon_days: int = LTV_DAYS) -> PipelineModel:
    """Boosted trees predicting spend in the horizon after the cutoff."""
    f = customer_window_features(purchases, horizon_days)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=CUSTOMER_FEATURES, outputCol="features"),
                            GBTRegressor(labelCol="spend_after", maxIter=30, maxDepth=4, seed=SEED)])
    return pipe.fit(f.where(~F.col("is_test")))


def score_ltv(model: PipelineModel, purchases: DataFrame, horizon_days: int = LTV_DAYS, every_row: bool = False) -> DataFrame:
    f = customer_window_features(purchases, horizon_days)
    return model.transform(_to_score(f, every_row)).select("customer_id", "spend_after", "prediction")


def fit_ltv(purchases: DataFrame, horizon_days: int = LTV_DAYS, every_row: bool = False) -> DataFrame:
    frame = kept_customers(purchases, horizon_days)
    return score_ltv(ltv_model(frame, horizon_days), frame, horizon_days, every_row)


def churn_model(purchases: DataFrame, horizon_days: int = CHURN_DAYS) -> PipelineModel:
    """Boosted-tree classifier of churn, fitted on the training customers."""
    f = customer_window_features(purchases, horizon_days)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=CUSTOMER_FEATURES, outputCol="features"),
                            GBTClassifier(labelCol="churned", maxIter=30, maxDepth=4, seed=SEED)])
    return pipe.fit(f.where(~F.col("is_test")))


def score_churn(model: PipelineModel, purchases: DataFrame, horizon_days: int = CHURN_DAYS) -> DataFrame:
    """Every customer's probability, banded high >= 0.7, medium >= 0.4, else low."""
    p = vector_to_array("probability")[1]
    s = model.transform(customer_window_features(purchases, horizon_days)).select("customer_id", "churned", "is_test", "prediction", p.alias("churn_probability"))
    return s.withColumn("risk_band", F.when(F.col("churn_probability") >= 0.7, "high")
                        .when(F.col("churn_probability") >= 0.4, "medium").otherwise("low"))


def fit_churn(purchases: DataFrame, horizon_days: int = CHURN_DAYS) -> DataFrame:
    frame = kept_customers(purchases, horizon_days)
    return score_churn(churn_model(frame, horizon_days), frame, horizon_days)


# ---------------------------------------------------------------- recommendations
USER_BLOCK, ITEM_BLOCK = retrieval.USERS, retrieval.LAYER


def top_items(user_factors: DataFrame, item_factors: DataFrame, owned: DataFrame, floors: DataFrame | None, k: int) -> DataFrame:
    """(user_id, product_id, prediction, rank, products): each user's exact k
    best items that are not owned, by the tree of ``retrieval``."""
    return retrieval.top_items(user_factors, item_factors, owned, k, floors, USER_BLOCK, ITEM_BLOCK)


def with_split(interactions: DataFrame) -> DataFrame:
    """Interactions and their holdout flag; a split frame stays as it is."""
    return interactions if "is_test" in interactions.columns else interactions.withColumn("is_test", holdout_flag("user_id", "product_id"))


def recommendation_factors(interactions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """User and item factors of implicit-feedback ALS on the training purchase counts."""
    blocks = max(10, interactions.sparkSession.sparkContext.defaultParallelism)  # as wide as the cluster
    als = ALS(userCol="user_id", itemCol="product_id", ratingCol="purchases", implicitPrefs=True, rank=10,
              maxIter=10, regParam=0.1, alpha=1.0, seed=SEED, coldStartStrategy="drop",
              numUserBlocks=blocks, numItemBlocks=blocks)
    model = als.fit(with_split(interactions).where(~F.col("is_test")))
    return model.userFactors, model.itemFactors


def recommend(users: DataFrame, items: DataFrame, interactions: DataFrame, k: int = 10) -> DataFrame:
    """(user_id, recommendations, products): of all items the user has not in
    the training set, the k best, exactly."""
    train = with_split(interactions).where(~F.col("is_test"))
    top = top_items(users, items, train.select("user_id", "product_id"), None, k)
    return top.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("rank", "product_id", F.col("prediction").alias("rating")))).alias("r"),
                                      F.max("products").alias("products")) \
        .select("user_id", F.transform("r", lambda x: F.struct(x["product_id"].alias("product_id"), x["rating"].alias("rating"))).alias("recommendations"), "products")


def fit_recommendations(interactions: DataFrame, product_types: DataFrame, k: int = 10):
    split = kept(with_split(interactions), "interactions-split")  # for the factors, the owned items and the scores
    users, items = recommendation_factors(split)
    return split, recommend(users, items, split, k)


def recommendation_rows(recs: DataFrame) -> DataFrame:
    return recs.select("user_id", F.posexplode("recommendations").alias("pos", "r")).select(
        "user_id", (F.col("pos") + 1).alias("rank"), F.col("r.product_id").alias("product_id"),
        F.col("r.rating").alias("score"))


def ranking_scores(interactions_split: DataFrame, recs: DataFrame, product_types: DataFrame,
                   k: int = 10) -> DataFrame:
    """MAP@k and NDCG@k (binary relevance) against the held-out items of
    each user, averaged over users with both recommendations and held-out
    items; catalogue coverage = distinct recommended items / all items;
    diversity = 1 - mean probability that two items of a list share a
    product type (from the type counts of each list, no pairs are formed).

    No per-user item list is collected: a user's held-out items enter as
    a count and as hits of a join with the user's k recommendations, so a
    user with a third of all interactions costs one aggregate row.
    """
    import math
    truth = interactions_split.where("is_test").select("user_id", "product_id").distinct()
    n_truth = truth.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_truth"))
    rows = kept(recommendation_rows(recs), "recommendation-rows")  # for the hits, the coverage and the diversity
    hits = (rows.where(F.col("rank") <= k).join(truth.withColumn("hit", F.lit(1)), ["user_id", "product_id"], "left")
            .withColumn("hit", F.coalesce("hit", F.lit(0))))
    upto = Window.partitionBy("user_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    hits = hits.withColumn("hits_so_far", F.sum("hit").over(upto))
    per_user = hits.groupBy("user_id").agg(
        F.sum(F.when(F.col("hit") == 1, F.col("hits_so_far") / F.col("rank"))).alias("prec_sum"),
        F.sum(F.when(F.col("hit") == 1, F.lit(1.0) / F.log2(F.col("rank") + 1))).alias("dcg"))
    # ideal DCG for m relevant items, m = 1..k
    ideal = F.array(*[F.lit(sum(1.0 / math.log2(i + 2) for i in range(m))) for m in range(1, k + 1)])
    u = per_user.join(n_truth, "user_id").withColumn("m", F.least(F.col("n_truth"), F.lit(k)).cast("int"))
    u = u.select(F.coalesce(F.col("prec_sum") / F.col("m"), F.lit(0.0)).alias("ap"),
                 F.coalesce(F.col("dcg") / F.element_at(ideal, F.col("m")), F.lit(0.0)).alias("ndcg"))
    quality = u.agg(F.avg("ap").alias(f"map_at_{k}"), F.avg("ndcg").alias(f"ndcg_at_{k}"))
    n_items = interactions_split.agg(F.count_distinct("product_id")).scalar()
    typed = rows.join(product_types, "product_id", "left")
    per_list_type = typed.groupBy("user_id", "product_type").agg(F.count(F.lit(1)).alias("c"))
    per_list = per_list_type.groupBy("user_id").agg(F.sum(F.col("c") * (F.col("c") - 1)).alias("same"),
                                                    F.sum("c").alias("n"))
    div = per_list.agg((F.lit(1.0) - F.avg(safe_div("same", F.col("n") * (F.col("n") - 1)))).alias("diversity"))
    cov = rows.agg(safe_div(F.count_distinct("product_id"), n_items).alias("coverage"))
    from postlens.operators.common import side_by_side
    return side_by_side(quality, cov, div)


# ---------------------------------------------------------------- pricing (closed form)
ELASTICITY_REGRESSORS = ("ln(unit_price)", "discount", "sin(month * pi() / 6)", "cos(month * pi() / 6)")


def ridge(rows: DataFrame, y: str, regressors: tuple[str, ...], by: list[str], penalty: float = 1.0) -> DataFrame:
    """(by..., observations, weights): ridge regression of ``y`` on a constant
    (without penalty) and ``regressors`` (SQL expressions) in each group. Each
    column is set against its group's mean, which changes the constant only
    and keeps the matrix well conditioned; the means are summed in the same
    pass over the rows as the products, from which they are taken off."""
    xs = [F.lit(1.0), *[F.expr(r) for r in regressors]]
    k = len(xs)
    total = linear.normal_equations(rows, xs, F.expr(y), by)
    # products about the means: sum((x - mx)(z - mz)) = sum(x z) - sum(x) sum(z) / n
    cell = lambda i, j: F.element_at(F.element_at(F.col("m"), i + 1), j + 1)
    about = lambda i, j: cell(i, j) - cell(0, i) * cell(0, j) / cell(0, 0)
    inner = F.array(*[F.array(*[about(i, j) + (penalty if i == j else 0.0) for j in range(1, k + 1)]) for i in range(1, k)])
    slopes = total.select(*by, F.col("n").alias("observations"), "m", inner.alias("c")).withColumn("slopes", linear.solve(F.col("c"), k - 1))
    level = (cell(0, k) - sum((F.element_at("slopes", i) * cell(0, i) for i in range(1, k)), F.lit(0.0))) / cell(0, 0)
    return slopes.select(*by, "observations", F.concat(F.array(level), "slopes").alias("weights"))


def elasticity_weights(price_points: DataFrame, penalty: float = 1.0) -> DataFrame:
    p = price_points.where((F.col("unit_price") > 0) & (F.col("quantity") > 0))
    return ridge(p, "ln(quantity)", ELASTICITY_REGRESSORS, ["product_type"], penalty)


def price_elasticity(price_points: DataFrame, lift_step: float = 0.05, penalty: float = 1.0) -> DataFrame:
    return price_changes(elasticity_weights(price_points, penalty), lift_step)


def price_changes(weights: DataFrame, lift_step: float = 0.05) -> DataFrame:
    """Per product type, ridge regression of ln(quantity) on ln(unit price),
    discount and month of the year (sine and cosine). The elasticity is the
    weight of the price: raise the price when it is > -1 (inelastic), lower it
    when < -1; expected revenue change for a ``lift_step`` price increase, in
    %, and the effect of a full discount on ln(quantity)."""
    g = weights.select("product_type", "observations", np_round(F.element_at("weights", 2), 6).alias("elasticity"),
                 np_round(F.element_at("weights", 3), 6).alias("discount_effect"))
    e = F.col("elasticity")
    return g.select("product_type", "observations", "elasticity", "discount_effect",
                    F.when(e > -1, "raise").when(e < -1, "lower").otherwise("keep").alias("suggested_change"),
                    ((F.pow(F.lit(1.0 + lift_step), F.lit(1.0) + e) - 1.0) * 100.0).alias("revenue_lift_percent"))


# ---------------------------------------------------------------- demand forecast
def forecast_frame(daily: DataFrame, horizon: int, future: bool = False) -> DataFrame:
    """Calendar-complete series with lags 0, 1, 7, 30, trailing 7-day mean,
    weekday and the target h days ahead; the seasonal-naive baseline is the
    value 7 days (35 for h = 30) before the target date. ``future`` keeps
    the rows whose target is not known."""
    from postlens.operators.windows import calendar_complete
    s = calendar_complete(daily)
    w = Window.partitionBy("metric").orderBy("date")
    base_lag = 35 if horizon >= 30 else 7
    f = s.select("metric", "date", "value",
                 F.lag("value", 1).over(w).alias("lag_1"), F.lag("value", 7).over(w).alias("lag_7"),
                 F.lag("value", 30).over(w).alias("lag_30"),
                 F.avg("value").over(w.rowsBetween(-6, 0)).alias("mean_7"),
                 F.dayofweek("date").cast("double").alias("weekday"),
                 F.lead("value", horizon).over(w).alias("target"),
                 F.lag("value", base_lag - horizon).over(w).alias("baseline") if base_lag > horizon
                 else F.col("value").alias("baseline"))
    return f.na.drop(subset=["lag_1", "lag_7", "lag_30", "baseline"] + ["target"] * (not future))


def _demand_split(daily: DataFrame, horizon: int) -> DataFrame:
    """Days with all lags and a known target; the last 20 % are the test set."""
    f = forecast_frame(daily, horizon)
    cut = exact_quantiles(f.withColumn("day", F.unix_date("date")), "day", [0.8]).select("quantile").scalar()
    return f.withColumn("is_test", F.unix_date("date") > cut)


def demand_model(daily: DataFrame, horizon: int) -> PipelineModel:
    """Boosted trees on the lag features, trained on the first 80 % of days."""
    feats = ["value", "lag_1", "lag_7", "lag_30", "mean_7", "weekday"]
    pipe = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"),
                            GBTRegressor(labelCol="target", maxIter=20, maxDepth=4, seed=SEED)])
    return pipe.fit(_demand_split(daily, horizon).where(~F.col("is_test")))


def score_demand(model: PipelineModel, daily: DataFrame, horizon: int, every_row: bool = False) -> DataFrame:
    """The last 20 % of days, or every day with lags, also where the target is still to come."""
    return model.transform(forecast_frame(daily, horizon, future=True) if every_row else _demand_split(daily, horizon).where("is_test"))


def fit_demand(daily: DataFrame, horizon: int, every_row: bool = False) -> DataFrame:
    return score_demand(demand_model(daily, horizon), daily, horizon, every_row)


YEARLY, WEEKLY, LEVEL_DAYS = 5, 3, 7


def fit_additive(series: DataFrame, upto: Column | None = None) -> DataFrame:
    """(metric, first, last, weights): trend and yearly and weekly seasonality
    of each metric's series, by least squares over the days ``upto`` marks
    (all by default): one aggregate of products, solved in columns."""
    span = series.groupBy("metric").agg(F.min("date").alias("first"), F.max("date").alias("last"))
    rows = series.where(upto) if upto is not None else series
    rows = rows.join(broadcast_if_rows_at_most(span), "metric")
    names, xs = linear.seasonal_design("date", F.col("first"), YEARLY, WEEKLY)
    total = linear.normal_equations(rows, xs, F.col("value"), ["metric"], linear.seasonal_penalty(YEARLY, WEEKLY))
    return span.join(total.select("metric", linear.solve(F.col("m"), len(xs)).alias("weights")), "metric")


def additive_value(series: DataFrame, fitted: DataFrame) -> DataFrame:
    """``series`` with ``additive``, the fitted trend and seasonality."""
    _, xs = linear.seasonal_design("date", F.col("first"), YEARLY, WEEKLY)
    return (series.join(broadcast_if_rows_at_most(fitted.select("metric", "first", "weights")), "metric")
            .withColumn("additive", linear.dot(F.col("weights"), xs)).drop("first", "weights"))


def demand_components(daily: DataFrame) -> DataFrame:
    """(metric, component, weight): the additive model of the whole series."""
    from postlens.operators.windows import calendar_complete
    names, _ = linear.seasonal_design("date", F.col("first"), YEARLY, WEEKLY)
    fitted = fit_additive(calendar_complete(daily))
    named = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("component"), F.col("weights").alias("weight"))
    return fitted.select("metric", F.explode(named).alias("c")).select("metric", "c.component", np_round("c.weight", 3).alias("weight"))


def demand_forecast(daily: DataFrame, horizons=(1, 7, 30)) -> DataFrame:
    """Per horizon: trend and seasonality fitted on the first 80 % of each
    metric's days, scored on the last 20 %; MAE and MAPE of the model and of the
    seasonal-naive baseline. The forecast for a day, made h days before it, is
    the additive value plus the mean error of the last 7 days known then."""
    from postlens.operators.windows import calendar_complete
    s = calendar_complete(daily).withColumn("day", F.unix_date("date"))
    cuts = exact_quantiles(s, "day", [0.8], ["metric"]).select("metric", F.col("quantile").alias("cut"))
    s = s.join(broadcast_if_rows_at_most(cuts), "metric")
    s = additive_value(s, fit_additive(s, F.col("day") <= F.col("cut")))
    w = Window.partitionBy("metric").orderBy("date")
    s = s.withColumn("off", F.avg(F.col("value") - F.col("additive")).over(w.rowsBetween(1 - LEVEL_DAYS, 0)))
    each = s.select("*", *[(F.col("additive") + F.lag("off", h).over(w)).alias(f"forecast_{h}") for h in horizons],
                    *[F.lag("value", 35 if h >= 30 else 7).over(w).alias(f"naive_{h}") for h in horizons]).where("day > cut")
    rows = each.select("value", F.explode(F.array(*[F.struct(F.lit(h).alias("horizon_days"), F.col(f"forecast_{h}").alias("forecast"), F.col(f"naive_{h}").alias("naive"))
                                                    for h in horizons])).alias("h")).select("value", "h.*").dropna()
    ape = lambda c: F.avg(F.when(F.col("value") != 0, F.abs(F.col(c) - F.col("value")) / F.abs(F.col("value")))) * 100.0
    return rows.groupBy("horizon_days").agg(
        F.count("*").alias("test_days"), np_round(F.avg(F.abs(F.col("forecast") - F.col("value"))), 3).alias("model_mae"), np_round(ape("forecast"), 3).alias("model_mape"),
        np_round(F.avg(F.abs(F.col("naive") - F.col("value"))), 3).alias("baseline_mae"), np_round(ape("naive"), 3).alias("baseline_mape"))


def demand_outlook(daily: DataFrame, days: int = 30) -> DataFrame:
    """(metric, date, days_ahead, forecast): the days after the last one, from
    the model of the whole series and its mean error over the last week."""
    from postlens.operators.windows import calendar_complete
    s = calendar_complete(daily)
    fitted = fit_additive(s)
    known = additive_value(s, fitted).join(broadcast_if_rows_at_most(fitted.select("metric", "last")), "metric")
    off = known.where(F.date_diff("last", "date") < LEVEL_DAYS).groupBy("metric").agg(F.avg(F.col("value") - F.col("additive")).alias("off"))
    ahead = fitted.select("metric", "last", F.explode(F.sequence(F.lit(1), F.lit(days))).alias("days_ahead")).select(
        "metric", F.date_add("last", F.col("days_ahead")).alias("date"), "days_ahead")
    return (additive_value(ahead, fitted).join(broadcast_if_rows_at_most(off), "metric")
            .select("metric", "date", "days_ahead", np_round(F.col("additive") + F.col("off"), 3).alias("forecast")))


# ---------------------------------------------------------------- text
def sentiment_frame(text_labels: DataFrame) -> DataFrame:
    return text_labels.withColumn("is_test", holdout_flag("doc_id"))


def sentiment_model(text_labels: DataFrame) -> PipelineModel:
    """Tokens -> hashed term frequencies -> IDF -> multinomial logistic
    regression over positive / neutral / negative. Whole texts are used."""
    pipe = Pipeline(stages=[
        StringIndexer(inputCol="label", outputCol="label_idx", stringOrderType="alphabetAsc"),
        RegexTokenizer(inputCol="text", outputCol="tokens", pattern=r"\W+", minTokenLength=2),
        HashingTF(inputCol="tokens", outputCol="tf", numFeatures=1 << 16),
        IDF(inputCol="tf", outputCol="features", minDocFreq=2),
        LogisticRegression(family="multinomial", labelCol="label_idx", regParam=0.01, maxIter=50)])
    return pipe.fit(sentiment_frame(text_labels).where(~F.col("is_test")))


def score_sentiment(model: PipelineModel, text_labels: DataFrame, every_row: bool = False) -> DataFrame:
    return model.transform(_to_score(sentiment_frame(text_labels), every_row)).select(
        "doc_id", "label", "label_idx", "prediction", F.array_max(vector_to_array("probability")).alias("confidence"))


def fit_sentiment(text_labels: DataFrame, every_row: bool = False) -> DataFrame:
    return score_sentiment(sentiment_model(text_labels), text_labels, every_row)


def sentiment_scores(scored: DataFrame) -> DataFrame:
    """Per class precision and recall, with the overall accuracy."""
    acc = scored.agg(safe_div(F.count_if(F.col("label_idx") == F.col("prediction")), F.count(F.lit(1)))).scalar()
    labels = scored.select("label", "label_idx").distinct()
    pred_counts = scored.groupBy(F.col("prediction").alias("label_idx")).agg(
        F.count(F.lit(1)).alias("predicted"),
        F.count_if(F.col("label_idx") == F.col("prediction")).alias("correct"))
    true_counts = scored.groupBy("label_idx").agg(F.count(F.lit(1)).alias("actual"))
    return (labels.join(true_counts, "label_idx", "left").join(pred_counts, "label_idx", "left")
            .select("label", "actual", F.coalesce("predicted", F.lit(0)).alias("predicted"),
                    safe_div("correct", "predicted").alias("precision"),
                    safe_div(F.coalesce("correct", F.lit(0)), "actual").alias("recall"),
                    acc.alias("accuracy")))


# ---------------------------------------------------------------- outliers
SHIPMENT_FEATURES = ["weight", "cost", "discount", "tax", "order_value"]


@dataclass
class FraudModel:
    """Scaler and principal axes, how many of them count, the forest, and
    the quantiles that each score is set against."""

    axes: PipelineModel
    components: int
    forest: isolation.Forest
    cuts: dict[str, float]


def principal_axes(shipments: DataFrame, variance: float = 0.9) -> tuple[PipelineModel, int]:
    """Standardising scaler and all principal components of the features,
    and the number of leading ones that reach ``variance`` of the variance."""
    axes = Pipeline(stages=[VectorAssembler(inputCols=SHIPMENT_FEATURES, outputCol="raw", handleInvalid="skip"),
                            StandardScaler(inputCol="raw", outputCol="z", withMean=True, withStd=True),
                            PCA(k=len(SHIPMENT_FEATURES), inputCol="z", outputCol="pc")]).fit(shipments)
    cum, k = 0.0, 0
    for v in axes.stages[-1].explainedVariance.toArray():
        cum += float(v)
        k += 1
        if cum >= variance:
            break
    return axes, k


def fraud_views(model: FraudModel, shipments: DataFrame) -> DataFrame:
    """``shipments`` with ``isolation_score`` and ``reconstruction_error``
    (|z|^2 - |projection|^2; the axes are orthonormal)."""
    def sq(arr):
        return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x * x)

    error = sq(vector_to_array("z")) - sq(F.slice(vector_to_array("pc"), 1, model.components))
    seen = model.axes.transform(shipments).select(*shipments.columns, error.alias("reconstruction_error"), F.lit(model.components).alias("components"))
    return isolation.score(seen, model.forest)


def _anomaly(cuts: dict[str, float]) -> Column:
    against = lambda c: F.coalesce(safe_div(F.col(c), F.col(c) + F.lit(cuts[c])), F.lit(0.0))
    return (against("isolation_score") + against("reconstruction_error")) / 2.0


def fit_fraud(spark: SparkSession, shipments: DataFrame, variance: float = 0.9, contamination: float = 0.05,
              trees: int = isolation.TREES, psi: int = isolation.PSI, stored: bool = False) -> tuple[FraudModel, DataFrame]:
    """The model and ``fraud_views`` of the shipments it was fitted on. The
    shipments are computed once for all passes (``stored`` ones are read as
    they are), and so are their scores."""
    shipments = shipments if stored else kept(shipments, "fraud-shipments")
    axes, k = principal_axes(shipments, variance)
    model = FraudModel(axes, k, isolation.grow(shipments, "shipment_id", SHIPMENT_FEATURES, trees, psi), {})
    views = kept(fraud_views(model, shipments), "fraud-scores")

    def cut(df: DataFrame, column: str) -> float:
        found = exact_quantiles(df, column, [1.0 - contamination]).first()
        return found["quantile"] if found else 0.0

    model.cuts = {c: cut(views, c) for c in ("isolation_score", "reconstruction_error")}
    model.cuts["anomaly_score"] = cut(views.withColumn("anomaly_score", _anomaly(model.cuts)), "anomaly_score")
    return model, views


def fraud_model(spark: SparkSession, shipments: DataFrame, variance: float = 0.9, contamination: float = 0.05,
                trees: int = isolation.TREES, psi: int = isolation.PSI) -> FraudModel:
    return fit_fraud(spark, shipments, variance, contamination, trees, psi)[0]


def score_fraud(model: FraudModel, shipments: DataFrame) -> DataFrame:
    """Two views of how unusual a shipment is, isolation forest and
    reconstruction error, and their mean. Each is first set against its own
    quantile, ``x / (x + quantile)``, which is one half there. Rows above the
    exact quantile of the mean are flagged."""
    return flagged(model, fraud_views(model, shipments))


def flagged(model: FraudModel, views: DataFrame) -> DataFrame:
    both = views.withColumn("anomaly_score", _anomaly(model.cuts))
    return both.withColumn("is_flagged", F.col("anomaly_score") > model.cuts["anomaly_score"])


def fraud_score(spark: SparkSession, shipments: DataFrame, variance: float = 0.9, contamination: float = 0.05,
                trees: int = isolation.TREES, psi: int = isolation.PSI) -> DataFrame:
    """``score_fraud`` with a model fitted on the shipments; the
    ``contamination`` share is flagged."""
    return flagged(*fit_fraud(spark, shipments, variance, contamination, trees, psi))


def metric_outliers(daily: DataFrame, flag_share: float = 0.05) -> DataFrame:
    """Robust z = 0.6745 * |x - median| / MAD per metric; flag the top
    ``flag_share`` (score at or above the 95th percentile, linear
    interpolation). A zero MAD gives a null score. The exact percentiles
    run as window aggregates over one metric's daily series (one row per
    day, bounded by the calendar), all on one partitioning."""
    by_metric = Window.partitionBy("metric")
    d = daily.withColumn("median", F.percentile("value", 0.5).over(by_metric))
    d = d.withColumn("mad", F.percentile(F.abs(F.col("value") - F.col("median")), 0.5).over(by_metric))
    d = d.withColumn("robust_z", safe_div(F.abs(F.col("value") - F.col("median")) * 0.6745,
                                          F.when(F.col("mad") > 0, F.col("mad"))))
    d = d.withColumn("_cut", F.percentile("robust_z", 1.0 - flag_share).over(by_metric))
    return d.select("metric", "date", "value", "median", "mad", "robust_z",
                    (F.col("robust_z") >= F.col("_cut")).alias("is_outlier"))


# ---------------------------------------------------------------- monitoring
def model_drift(predictions: DataFrame, bins: int = 10, floor: float = 1e-4) -> DataFrame:
    """Per model: population stability index of predicted values, the
    earlier half of the period (by prediction date, split at the midpoint
    of the model's date range) against the later half, over decile bins of
    the earlier half; bin shares floored at ``floor``; < 0.1 healthy, else
    needs_retraining. Accuracy change = later - earlier share of
    predictions within 10 % of the actual, in points."""
    p = predictions.where(F.col("actual_value").isNotNull())
    span = p.groupBy("model_type").agg(
        ((F.unix_date(F.min("prediction_date")) + F.unix_date(F.max("prediction_date"))) / 2.0).alias("mid"))
    # Per-model tables have one row per model; the predictions are joined to
    # them on a key with few values, so they are broadcast (after a row-count
    # check) instead of shuffling each model's predictions into one task.
    p = p.join(broadcast_if_rows_at_most(span), "model_type").withColumn(
        "later", F.unix_date("prediction_date") > F.col("mid"))
    qs = [i / bins for i in range(1, bins)]
    # one row a model and decile, at exact ranks
    edges = (exact_quantiles(p.where(~F.col("later")), "predicted_value", qs, ["model_type"])
             .groupBy("model_type").agg(F.array_sort(F.collect_list("quantile")).alias("edges")))
    p = p.join(broadcast_if_rows_at_most(edges), "model_type")
    bin_of = F.size(F.filter("edges", lambda e: e < F.col("predicted_value")))
    # Same rule as the model performance view: |p - a| / a <= 0.1.
    within = F.coalesce(safe_div(F.abs(F.col("predicted_value") - F.col("actual_value")), "actual_value") <= 0.1,
                        F.lit(False)).cast("double")
    per_bin = p.groupBy("model_type", bin_of.alias("bin")).agg(
        F.count_if(~F.col("later")).alias("n_early"), F.count_if("later").alias("n_late"))
    tot = per_bin.groupBy("model_type").agg(F.sum("n_early").alias("t_early"), F.sum("n_late").alias("t_late"))
    b = per_bin.join(tot, "model_type").select(
        "model_type", F.greatest(safe_div("n_early", "t_early"), F.lit(floor)).alias("e"),
        F.greatest(safe_div("n_late", "t_late"), F.lit(floor)).alias("a"))
    psi = b.groupBy("model_type").agg(F.sum((F.col("a") - F.col("e")) * F.ln(F.col("a") / F.col("e"))).alias("psi"))
    acc = p.groupBy("model_type").agg(
        F.avg(F.when(~F.col("later"), within)).alias("acc_early"), F.avg(F.when(F.col("later"), within)).alias("acc_late"))
    return psi.join(acc, "model_type").select(
        "model_type", np_round("psi", 4).alias("drift_score"),
        ((F.col("acc_late") - F.col("acc_early")) * 100.0).alias("accuracy_change_points"),
        F.when(F.col("psi") < 0.1, "healthy").otherwise("needs_retraining").alias("status"),
        (F.col("psi") >= 0.1).alias("retraining_required"))
