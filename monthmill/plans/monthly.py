"""Months, markets, manifests, completeness, activity features and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from monthmill.functions import dates
from monthmill.operators import features, lookups, monthstore, routing, shares
from monthmill.plans.registry import query
from monthmill.session import scratch_path
from monthmill.sinks import buckets
from monthmill.plans.stand_ins import (
    MARKET_SQL,
    REFERENCE_MONTH,
    REQUEST_ORDER,
    market_months,
    user_markets,
)
from monthmill.sources.tables import parquet_table

_PERIODS_SQL = ",\n".join(
    f"""count(*) FILTER (WHERE k = {k}) AS brq_count_p_{k},
    count(DISTINCT CASE WHEN k = {k} THEN o_orderdate::DATE END) AS num_days_p_{k}"""
    for k in range(features.PERIODS)
)


def _periods_from(month: str) -> str:
    """Requests of the six months up to ``month`` with their distance ``k`` in months."""
    return f"""(
        SELECT *, datediff('month', o_orderdate, TIMESTAMP '{month}') AS k FROM orders
        WHERE o_orderdate >= TIMESTAMP '{month}' - INTERVAL 5 MONTH
        AND o_orderdate < TIMESTAMP '{month}' + INTERVAL 1 MONTH) AS periods"""


@query(
    """
    SELECT o_orderkey,
        year(o_orderdate)::INT AS run_year, month(o_orderdate)::INT AS run_month,
        strftime(o_orderdate, '%Y%m') AS month_id,
        strftime(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH, '%Y%m') AS previous_id,
        strftime(o_orderdate::DATE - 30, '%Y%m') AS back_id,
        strftime(o_orderdate::DATE - 30, '%Y') AS back_year,
        strftime(o_orderdate::DATE - 30, '%m') AS back_month
    FROM orders
    """
)
def month_shift(spark: SparkSession, folder: str) -> DataFrame:
    """Run month, the month before, and the month of thirty days back."""
    at = F.col("o_orderdate")
    run = dates.run_month(at)
    before = dates.subtract_months(run["year"], run["month"], 1)
    back = dates.days_back(at)
    return parquet_table(spark, folder, "orders").select(
        "o_orderkey",
        run["year"].alias("run_year"),
        run["month"].alias("run_month"),
        dates.month_id(at).alias("month_id"),
        dates.month_id_of(before["year"], before["month"]).alias("previous_id"),
        back["month_id"].alias("back_id"),
        back["year"].alias("back_year"),
        back["month"].alias("back_month"),
    )


@query(
    f"""
    WITH m AS (
        SELECT DISTINCT {MARKET_SQL} AS market, strftime(o_orderdate, '%Y%m') AS data_month
        FROM orders JOIN customer ON o_custkey = c_custkey),
    r AS (SELECT *,
        CASE WHEN market = 'MY' THEN 'own' WHEN market IN ('SG','PH','TH','BD','ID') THEN 'shared' END AS source,
        CASE WHEN market IN ('MY','TH','ID') THEN 'v1' WHEN market IN ('BD','PH','SG') THEN 'v2'
            ELSE 'fallback' END AS variant FROM m),
    t AS (SELECT r.*, model_type FROM r CROSS JOIN (VALUES ('age'), ('gender')) AS types(model_type))
    SELECT 'label' AS step, market, NULL AS model_type, data_month, source AS route,
        'demographic_label_generation_' || market || '_' || data_month AS job FROM r WHERE source IS NOT NULL
    UNION ALL
    SELECT 'train', market, model_type, data_month, variant,
        'demographic_training_' || market || '_' || model_type || '_' || data_month FROM t WHERE variant <> 'fallback'
    UNION ALL
    SELECT 'predict', market, model_type, data_month, variant,
        'demographic_prediction_' || market || '_' || model_type || '_' || data_month FROM t
    """
)
def run_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """All jobs of the months in which a market has data."""
    return routing.manifest(market_months(spark, folder))


@query(
    f"""
    SELECT CASE WHEN market = 'MY' THEN 'own' WHEN market IN ('SG','PH','TH','BD','ID') THEN 'shared' END AS label_source,
        CASE WHEN market IN ('MY','TH','ID') THEN 'v1' WHEN market IN ('BD','PH','SG') THEN 'v2'
            ELSE 'fallback' END AS variant, count(*) AS n_users, count(DISTINCT market) AS n_markets
    FROM (SELECT {MARKET_SQL} AS market FROM customer) GROUP BY 1, 2
    """
)
def market_routes(spark: SparkSession, folder: str) -> DataFrame:
    """Users and markets on each route."""
    per_market = user_markets(spark, folder).groupBy("market").agg(F.count("*").alias("n"))
    routed = routing.routes(per_market)
    return routed.groupBy("label_source", "variant").agg(
        F.sum("n").alias("n_users"), F.count("*").alias("n_markets")
    )


@query(
    """
    SELECT c_custkey, n_name AS market, r_name AS size, r_regionkey * 10 + 5 AS num_executors
    FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    """
)
def market_settings(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's market with the settings of its size class (here: its region)."""
    region = parquet_table(spark, folder, "region")
    nation = parquet_table(spark, folder, "nation")
    settings = region.select(F.col("r_name").alias("size"), (F.col("r_regionkey") * 10 + 5).alias("num_executors"))
    sizes = region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("size"))
    markets = nation.join(sizes, "n_regionkey").select("n_nationkey", F.col("n_name").alias("market"), "size")
    configured = routing.with_settings(markets, settings)
    customers = parquet_table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return lookups.lookup(customers, configured, "n_nationkey", "inner").drop("n_nationkey")


@query(
    """
    WITH present AS (
        SELECT DISTINCT c_nationkey AS nation, o_orderstatus AS status, date_trunc('month', o_orderdate)::DATE AS m
        FROM orders JOIN customer ON o_custkey = c_custkey),
    months AS (
        SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate), INTERVAL 1 MONTH))::DATE AS m
        FROM orders),
    spine AS (
        SELECT n_nationkey AS nation, status, m FROM nation
        CROSS JOIN (VALUES ('F'), ('O'), ('P')) AS s(status) CROSS JOIN months)
    SELECT spine.nation, spine.status, strftime(spine.m, '%Y%m') AS data_month
    FROM spine LEFT JOIN present USING (nation, status, m) WHERE present.m IS NULL
    """
)
def missing_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Market, type and month combinations that should have requests and have none."""
    orders = parquet_table(spark, folder, "orders")
    month = dates.month_of(F.col("o_orderdate"))
    users = parquet_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation")
    )
    per_user = orders.select("o_custkey", F.col("o_orderstatus").alias("status"), month.alias("month")).distinct()
    present = per_user.join(users, "o_custkey").select("nation", "status", "month").distinct()
    span = orders.agg(F.struct(F.min(month).alias("first"), F.max(month).alias("last"))).scalar()
    months = F.sequence(span["first"], span["last"], F.expr("interval 1 month"))
    nations = parquet_table(spark, folder, "nation").select(F.col("n_nationkey").alias("nation"))
    expected = routing.with_model_types(nations, ["F", "O", "P"]).withColumnRenamed("model_type", "status")
    expected = expected.withColumn("month", F.explode(months))
    gone = lookups.missing(expected, present, ["nation", "status", "month"])
    return gone.select("nation", "status", dates.month_id(F.col("month")).alias("data_month"))


@query(
    """
    SELECT o_custkey, strftime(o_orderdate, '%Y%m') AS month, count(*) AS brq_count,
        count(DISTINCT o_orderdate::DATE) AS num_days
    FROM orders GROUP BY 1, 2
    """
)
def monthly_features(spark: SparkSession, folder: str) -> DataFrame:
    """Requests and active days per user and month."""
    activity = features.monthly_activity(parquet_table(spark, folder, "orders"), "o_custkey", "o_orderdate")
    return activity.withColumn("month", dates.month_id(F.col("month")))


@query(f"SELECT o_custkey, {_PERIODS_SQL} FROM {_periods_from('2001-07-01')} GROUP BY o_custkey")
def period_pivot(spark: SparkSession, folder: str) -> DataFrame:
    """Requests and active days of the last six months as columns."""
    return features.period_features(
        parquet_table(spark, folder, "orders"), "o_custkey", "o_orderdate", REFERENCE_MONTH
    )


@query(
    """
    SELECT user_id, count(*) FILTER (WHERE event_type <> before) AS n_switches FROM (
        SELECT user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
    GROUP BY user_id
    """
)
def carrier_switches(spark: SparkSession, folder: str) -> DataFrame:
    """How often each user changes between event types."""
    return features.carrier_switches(parquet_table(spark, folder, "events"), "user_id", ["ts", "event_id"], "event_type")


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_custkey IN (
        SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderpriority) = 1)
    """
)
def single_carrier(spark: SparkSession, folder: str) -> DataFrame:
    """The requests of users with one carrier."""
    requests = parquet_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return features.keep_single_carrier(requests, "o_custkey", "o_orderpriority")


_FEATURES_SQL = f"""
    SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS carrier, {_PERIODS_SQL},
        count(*) FILTER (WHERE o_orderpriority <> before) AS n_switches
    FROM (SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before
        FROM %s) GROUP BY o_custkey
"""


@query(_FEATURES_SQL % _periods_from("2001-07-01"))
def stored_month_features(spark: SparkSession, folder: str) -> DataFrame:
    """The same features from a table with a row per user and month, to which one month at a time was added."""
    orders = parquet_table(spark, folder, "orders")
    base = scratch_path(spark, "months")
    for back in reversed(range(features.PERIODS)):
        monthstore.store_month(orders, base, "o_custkey", REQUEST_ORDER, "o_orderpriority", features.month_shift(REFERENCE_MONTH, -back))
    return monthstore.stored_features(spark, base, orders.schema["o_custkey"], orders.schema["o_orderpriority"], REFERENCE_MONTH)


@query(_FEATURES_SQL % _periods_from("2001-07-01"))
def request_features(spark: SparkSession, folder: str) -> DataFrame:
    """All features of a user in one table."""
    return features.request_features(
        parquet_table(spark, folder, "orders"), "o_custkey", REQUEST_ORDER, "o_orderpriority", REFERENCE_MONTH
    )


@query(
    f"""
    SELECT f.*, CASE WHEN later.o_custkey IS NULL THEN 1 ELSE 0 END AS is_churn
    FROM ({_FEATURES_SQL % _periods_from("2001-06-01")}) AS f LEFT JOIN (
        SELECT DISTINCT o_custkey FROM orders
        WHERE o_orderdate >= TIMESTAMP '2001-07-01' AND o_orderdate < TIMESTAMP '2001-08-01') AS later USING (o_custkey)
    """
)
def churn_training_set(spark: SparkSession, folder: str) -> DataFrame:
    """Features up to a month with the label of the month after."""
    orders = parquet_table(spark, folder, "orders")
    month = features.month_shift(REFERENCE_MONTH, -1)
    known = features.request_features(orders, "o_custkey", REQUEST_ORDER, "o_orderpriority", month)
    return features.churn_labels(orders, known, "o_custkey", "o_orderdate", month)


_NEXT_LABEL_SQL = """
    WITH f AS (
        SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS m, count(*) AS brq_count,
            count(DISTINCT o_orderdate::DATE) AS num_days FROM orders GROUP BY 1, 2),
    l AS (
        SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS m,
            CASE WHEN max(o_totalprice) >= 300000 THEN 1 ELSE 0 END AS label FROM orders GROUP BY 1, 2)
    SELECT f.o_custkey, strftime(f.m, '%Y%m') AS month, brq_count, num_days, label
    FROM f JOIN l ON l.o_custkey = f.o_custkey AND l.m = (f.m + INTERVAL 1 MONTH)::DATE
    """


@query(_NEXT_LABEL_SQL)
def feature_label(spark: SparkSession, folder: str) -> DataFrame:
    """Features of each month beside the label of the next."""
    orders = parquet_table(spark, folder, "orders")
    known = features.monthly_activity(orders, "o_custkey", "o_orderdate")
    high = F.when(F.max("o_totalprice") >= 300000, 1).otherwise(0)
    labels = features.next_month_labels(orders, "o_custkey", "o_orderdate", label=high)
    return known.join(labels, ["o_custkey", "month"]).withColumn("month", dates.month_id(F.col("month")))


@query(_NEXT_LABEL_SQL)
def bucketed_feature_label(spark: SparkSession, folder: str) -> DataFrame:
    """The same from two tables stored in buckets by user and month, joined without a shuffle."""
    orders = parquet_table(spark, folder, "orders")
    known = features.monthly_activity(orders, "o_custkey", "o_orderdate")
    high = F.when(F.max("o_totalprice") >= 300000, 1).otherwise(0)
    labels = features.next_month_labels(orders, "o_custkey", "o_orderdate", label=high)
    for name, rows in (("activity", known), ("labels", labels)):
        buckets.write_buckets(rows, "monthmill", name, scratch_path(spark, name), ["o_custkey", "month"], 8)
    joined = spark.table("monthmill.activity").join(spark.table("monthmill.labels"), ["o_custkey", "month"])
    return joined.withColumn("month", dates.month_id(F.col("month")))


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    WHERE EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_type = 'ECONOMY')
    """
)
def valid_only(spark: SparkSession, folder: str) -> DataFrame:
    """Only the rows whose app is on the list."""
    listed = parquet_table(spark, folder, "part").where(F.col("p_type") == "ECONOMY")
    lines = parquet_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return lookups.keep_listed(lines, listed.select(F.col("p_partkey").alias("l_partkey")), "l_partkey")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, p_brand AS bundle, p_type AS segment
    FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 25) ON p_partkey = l_partkey
    """
)
def app_segment(spark: SparkSession, folder: str) -> DataFrame:
    """Every row with the bundle and segment of its app, where the reference knows it."""
    known = parquet_table(spark, folder, "part").where(F.col("p_size") <= 25)
    reference = known.select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("bundle"), F.col("p_type").alias("segment")
    )
    lines = parquet_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lookups.attach(lines, reference, "l_partkey")


@query(
    """
    SELECT doc_id, source, n_chars, quality AS prediction FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def input_with_prediction(spark: SparkSession, folder: str) -> DataFrame:
    """Every input record beside its prediction, if there is one."""
    inputs = parquet_table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    predicted = parquet_table(spark, folder, "labels").select("doc_id", F.col("quality").alias("prediction"))
    return lookups.with_predictions(inputs, predicted, "doc_id")


@query(
    """
    WITH c AS (
        SELECT c_nationkey AS market, c_mktsegment AS class, count(*) AS n FROM customer GROUP BY 1, 2),
    s AS (SELECT *, n / sum(n) OVER (PARTITION BY market) AS share FROM c),
    g AS (
        SELECT n_regionkey, class, sum(n) AS n FROM c JOIN nation ON n_nationkey = market GROUP BY 1, 2),
    t AS (SELECT *, n / sum(n) OVER (PARTITION BY n_regionkey) AS target_share FROM g),
    x AS (SELECT n_nationkey AS market, class, target_share FROM t JOIN nation ON t.n_regionkey = nation.n_regionkey)
    SELECT market, class, n, round(share, 6) AS share, round(target_share, 6) AS target_share,
        round(target_share / share, 6) AS weight
    FROM s FULL JOIN x USING (market, class)
    """
)
def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    """Weights that move the classes of a market to the distribution of its region."""
    nation = parquet_table(spark, folder, "nation").select(F.col("n_nationkey").alias("market"), "n_regionkey")
    users = parquet_table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("market"), F.col("c_mktsegment").alias("class")
    )
    predicted = shares.class_shares(users, "market", "class")
    counts = users.groupBy("market", "class").agg(F.count("*").alias("n"))
    regional = shares.class_shares(counts.join(nation, "market"), "n_regionkey", "class", rows="n")
    target = nation.join(regional.withColumnRenamed("share", "target_share").drop("n"), "n_regionkey")
    weights = shares.class_weights(predicted, target.drop("n_regionkey"), "market", "class")
    rounded = {c: F.round(c, 6) for c in ["share", "target_share", "weight"]}
    return weights.withColumns(rounded)
