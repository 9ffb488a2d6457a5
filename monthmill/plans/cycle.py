"""Whole jobs: the daily export and the monthly cycle."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from monthmill.functions import documents
from monthmill.operators import features, grouped, labels, metrics, models, trees
from monthmill.operators.routing import FIRST_VARIANT_MARKETS, OWN_LABEL_MARKETS, SECOND_VARIANT_MARKETS, SHARED_LABEL_MARKETS, routes
from monthmill.operators.slices import day_slice
from monthmill.plans.registry import query
from monthmill.plans.stand_ins import MARKET_SQL, REFERENCE_MONTH, REQUEST_ORDER, market_code, user_markets
from monthmill.session import durable, scratch_path
from monthmill.sinks import files, publish
from monthmill.sources import tables

LABEL = "is_churn"
#: Model types and their number of classes.
TYPE_CLASSES = {"age": 3, "gender": 2}


def _quoted(names: list[str]) -> str:
    return ", ".join(f"'{name}'" for name in names)


def export_day(users: DataFrame, day: str, base: str) -> str:
    """The daily job: the users created on a day as CSV under a run stamp."""
    return files.export_csv(day_slice(users, day), base)


def total_document(orders: DataFrame, column: str = "document") -> DataFrame:
    """One JSON document with the sum of all numbers in the given JSON maps."""
    total = F.sum(documents.map_total(documents.number_map(F.col(column))))
    return orders.agg(documents.result_document(total_order_value=F.coalesce(total, F.lit(0.0))).alias("document"))


def monthly_cycle(
    requests: DataFrame,
    markets: DataFrame,
    user: str,
    order: list[str],
    carrier: str,
    month: datetime.date,
    base: str,
    rounds: int = 20,
) -> DataFrame:
    """Label, train and score a month for all markets.

    Features reach up to the month before ``month``, labels come from ``month``.
    The training set is stored by market and month and read back, so that the
    fits do not repeat the joins. Users without a market take part in the model
    over all and are scored by it. Markets are trained by their variant; the
    model over all markets is stored as the historical one and scores markets
    without training. Returns the stored predictions beside their inputs.
    """
    month_id = month.strftime("%Y%m")
    before = features.month_shift(month, -1)
    known = features.request_features(requests, user, order, carrier, before)
    labelled = features.churn_labels(requests, known, user, order[0], before)
    rows = labelled.join(markets, user, "left").withColumn("data_month", F.lit(month_id))
    plain = [f for f in rows.schema.fields if f.name not in tables.MARKET_PARTITIONS]
    # A folder of its own per run: a rerun that no longer has a market must not read its old rows.
    run = uuid.uuid4().hex
    files.write_months(rows, f"{base}/training/run_id={run}")
    training = tables.market_months(rows.sparkSession, f"{base}/training/run_id={run}", plain).where(F.col("data_month") == month_id)

    numbers = [c for c in rows.columns if c.startswith(("brq_count_p_", "num_days_p_"))] + ["n_switches"]
    logistic = models.assembled(numbers, models.logistic(LABEL), ["carrier"])
    boosted = models.assembled(numbers, models.boosted(LABEL, rounds=rounds), ["carrier"])
    files.save_model(models.train(training, logistic), f"{base}/history", "all", LABEL, month_id)
    trained = models.train_routed(training, LABEL, {"v1": logistic, "v2": boosted})
    for market, model in trained.items():
        files.save_model(model, f"{base}/model", market, LABEL, month_id)
    historical = models.stored_model(f"{base}/history", "all", LABEL, month_id)
    scored = models.score_markets(training, trained, historical)
    files.write_months(scored, f"{base}/prediction/run_id={run}")
    kept = [*plain, *[f for f in scored.schema.fields if f.name in ("prediction", "score")]]
    return tables.market_months(rows.sparkSession, f"{base}/prediction/run_id={run}", kept).where(F.col("data_month") == month_id)


@query(
    f"""
    WITH known AS (
        SELECT DISTINCT o_custkey FROM orders
        WHERE o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderdate < TIMESTAMP '2001-07-01'),
    later AS (
        SELECT DISTINCT o_custkey FROM orders
        WHERE o_orderdate >= TIMESTAMP '2001-07-01' AND o_orderdate < TIMESTAMP '2001-08-01')
    SELECT {MARKET_SQL} AS market, '200107' AS data_month, count(*) AS n_scored,
        count(*) FILTER (WHERE later.o_custkey IS NULL) AS n_churn
    FROM known JOIN customer ON c_custkey = known.o_custkey LEFT JOIN later ON later.o_custkey = known.o_custkey
    GROUP BY 1
    """
)
def monthly_cycle_report(spark: SparkSession, folder: str) -> DataFrame:
    """The monthly cycle over all requests: users scored and users lost per market."""
    orders = tables.parquet_table(spark, folder, "orders")
    markets = user_markets(spark, folder).withColumnRenamed("user_id", "o_custkey")
    base = scratch_path(spark, "cycle")
    scored = monthly_cycle(orders, markets, "o_custkey", REQUEST_ORDER, "o_orderpriority", REFERENCE_MONTH, base)
    return scored.groupBy("market", "data_month").agg(
        F.count_if(F.col("prediction").isin(0.0, 1.0)).alias("n_scored"), F.sum(LABEL).alias("n_churn")
    )


@query()
def market_gates(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy of a trained model per market and whether it passes the gate."""
    orders = tables.parquet_table(spark, folder, "orders")
    before = features.month_shift(REFERENCE_MONTH, -1)
    known = features.request_features(orders, "o_custkey", REQUEST_ORDER, "o_orderpriority", before)
    rows = durable(features.churn_labels(orders, known, "o_custkey", "o_orderdate", before))
    numbers = [c for c in known.columns if c not in ("o_custkey", "carrier")]
    model = models.train(rows, models.assembled(numbers, models.logistic(LABEL), ["carrier"]))
    markets = user_markets(spark, folder).withColumnRenamed("user_id", "o_custkey")
    scored = models.score(rows, model).join(markets, "o_custkey", "left")
    report = metrics.quality_gate(scored, ["market"], "prediction", LABEL)
    return report.withColumn("accuracy", F.round("accuracy", 6))


@query(
    f"""
    WITH known AS (
        SELECT DISTINCT o_custkey FROM orders
        WHERE o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderdate < TIMESTAMP '2001-07-01'),
    people AS (
        SELECT {MARKET_SQL} AS market, CASE WHEN c_acctbal < 2500 THEN 0 WHEN c_acctbal < 6000 THEN 1 ELSE 2 END AS age,
            c_custkey % 2 AS gender
        FROM known JOIN customer ON c_custkey = known.o_custkey),
    per AS (
        SELECT market, 'age' AS model_type, age AS label FROM people UNION ALL SELECT market, 'gender', gender FROM people)
    SELECT market, model_type,
        CASE WHEN market IN ({_quoted(FIRST_VARIANT_MARKETS)}) THEN 'v1'
            WHEN market IN ({_quoted(SECOND_VARIANT_MARKETS)}) THEN 'v2' ELSE 'fallback' END AS variant,
        count(*) AS n_scored, count(*) AS n_in_classes, count(*) AS n_with_score,
        CASE WHEN market IN ({_quoted(FIRST_VARIANT_MARKETS)}) AND count(DISTINCT label) > 1
            THEN count(*) FILTER (WHERE label = 1)::DOUBLE END AS expected
    FROM per GROUP BY 1, 2
    """
)
def market_type_models(spark: SparkSession, folder: str) -> DataFrame:
    """Models for age (three classes) and gender (two) per market, by the market's variant; all users scored for both.

    The probabilities of class 1 of a fitted logistic model add up to the rows
    of that class; ``expected`` is their sum where the first variant has a model.
    """
    orders = tables.parquet_table(spark, folder, "orders")
    before = features.month_shift(REFERENCE_MONTH, -1)
    known = features.request_features(orders, "o_custkey", REQUEST_ORDER, "o_orderpriority", before)
    money = F.col("c_acctbal")
    customers = tables.parquet_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        market_code(F.col("c_nationkey")).alias("market"),
        F.when(money < 2500, 0).when(money < 6000, 1).otherwise(2).alias("age"),
        (F.col("c_custkey") % 2).cast("int").alias("gender"),
    )
    rows = durable(known.join(customers, "o_custkey"))
    numbers = [c for c in known.columns if c not in ("o_custkey", "carrier")]
    scored = routes(type_models(rows, numbers, ["carrier"], TYPE_CLASSES))
    classes = F.when(F.col("model_type") == "age", F.col("prediction").isin(0.0, 1.0, 2.0)).otherwise(F.col("prediction").isin(0.0, 1.0))
    own = (F.col("variant") == "v1") & (F.col("model") == F.col("market"))
    return scored.groupBy("market", "model_type", "variant").agg(
        F.count("*").alias("n_scored"),
        F.count_if(classes).alias("n_in_classes"),
        F.count_if(F.col("score").between(0, 1)).alias("n_with_score"),
        F.round(F.sum(F.when(own, F.col("probabilities")[1])), 1).alias("expected"),
    )


def type_models(rows: DataFrame, numbers: list[str], categories: list[str], kinds: dict[str, int], market: str = "market") -> DataFrame:
    """Trains all markets and model types and scores every row once per type, with ``model``, ``probabilities``, ``prediction`` and ``score``.

    Markets of the first variant and the model over all markets, which takes
    all other rows, are logistic and come from one sequence of jobs; markets of
    the second variant have boosted trees with a limit of leaves.
    """
    values = grouped.category_values(rows, categories)
    held = rows.withColumn("_features", grouped.features_of(rows, numbers, values))
    fitted = grouped.fit_groups(held, "_features", kinds, market)
    logistic = [t for t in fitted if t.market is None or t.market in FIRST_VARIANT_MARKETS]
    boosted = trees.fit_trees(held.where(F.col(market).isin(SECOND_VARIANT_MARKETS)), "_features", kinds, market)
    by_trees = trees.score_trees(held, boosted, "_features", market).withColumn("model", F.col(market))
    taken = [(m.market, m.kind) for m in boosted]
    by_weights = grouped.score_groups(held, grouped.model_table(rows.sparkSession, logistic), "_features", market)
    if taken:
        done = F.struct(F.col(market), F.col("model_type")).isin(*[F.struct(F.lit(m), F.lit(k)) for m, k in taken])
        by_weights = by_weights.where(~F.coalesce(done, F.lit(False)))
    return by_weights.unionByName(by_trees).drop("_features")


def label_job(usage: DataFrame, known: DataFrame, users: DataFrame, kinds: list[str], month: str, base: str, **options) -> str:
    """The label step of a month: labels of both routes, staged, validated and committed as one run; returns its name."""
    found = labels.market_labels(usage, known, users, kinds, **options).withColumn("data_month", F.lit(month))
    rules = {"a label is a class": F.col("label").between(0, 9), "a type that is asked for": F.col("model_type").isin(kinds)}
    covers = [(market, month) for market in [*OWN_LABEL_MARKETS, *SHARED_LABEL_MARKETS]]
    return publish.publish(found, base, rules, unique=["user_id", "model_type"], covers=covers)


@query(
    f"""
    WITH people AS (
        SELECT c_custkey AS user_id, {MARKET_SQL} AS market,
            CASE WHEN c_acctbal < 2500 THEN 0 WHEN c_acctbal < 6000 THEN 1 ELSE 2 END AS age, c_custkey % 2 AS gender
        FROM customer),
    usage AS (
        SELECT DISTINCT o_custkey AS user_id, p_type AS app
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey),
    long AS (
        SELECT user_id, market, 'age' AS model_type, age AS label FROM people
        UNION ALL SELECT user_id, market, 'gender', gender FROM people),
    own AS (SELECT * FROM long WHERE market IN ({_quoted(OWN_LABEL_MARKETS)})),
    counted AS (SELECT app, model_type, label, count(*) AS n FROM usage JOIN own USING (user_id) GROUP BY 1, 2, 3),
    apps AS (
        SELECT app, model_type, arg_max(label, n * 100 - label) AS label FROM counted
        GROUP BY 1, 2 HAVING sum(n) >= 3 AND max(n) >= 0.6 * sum(n)),
    votes AS (
        SELECT user_id, market, model_type, label, count(*) AS n
        FROM usage JOIN people USING (user_id) JOIN apps USING (app)
        WHERE market IN ({_quoted(SHARED_LABEL_MARKETS)}) GROUP BY 1, 2, 3, 4)
    SELECT user_id, market, 'own' AS label_source, model_type, label::INT AS label, '200107' AS data_month FROM own
    UNION ALL
    SELECT user_id, market, 'shared', model_type, arg_max(label, n * 100 - label)::INT, '200107' FROM votes GROUP BY 1, 2, 4
    """
)
def month_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The label step of both routes, published by market and month and read back through its commit."""
    orders, lines, parts = (tables.parquet_table(spark, folder, t) for t in ("orders", "lineitem", "part"))
    bought = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    usage = bought.select(F.col("o_custkey").alias("user_id"), F.col("p_type").alias("app"))
    money = F.col("c_acctbal")
    known = tables.parquet_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.when(money < 2500, 0).when(money < 6000, 1).otherwise(2).alias("age"),
        (F.col("c_custkey") % 2).cast("int").alias("gender"),
    )
    base = scratch_path(spark, "labels")
    label_job(usage, known, user_markets(spark, folder), ["age", "gender"], REFERENCE_MONTH.strftime("%Y%m"), base)
    key = known.schema["user_id"]
    return publish.published(spark, base, [key, *T.StructType.fromDDL("label_source string, model_type string, label int")])
