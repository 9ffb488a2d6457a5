"""Whole model jobs: the switches of a training, scoring by lines, and the historical fallback.

Each fits a logistic regression on the indicators of one category, whose
probabilities are shares of classes, so that SQL can tell what a model predicts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from monthmill.operators import models
from monthmill.plans.registry import query
from monthmill.session import durable, scratch_path
from monthmill.sinks.files import put, save_model
from monthmill.sources.tables import parquet_table

# Every switch by itself, and all together. Four seasons span three dimensions; a component without variance would unsettle a fit.
_VARIANTS = {
    "plain": models.Switches(),
    "single_carrier": models.Switches(single_carrier=True),
    "upsampled": models.Switches(upsampled=True),
    "balanced": models.Switches(balanced=True),
    "weighted": models.Switches(weight=0.35),
    "scaled": models.Switches(scale=True),
    "components": models.Switches(components=3),
    "together": models.Switches(True, True, True, 0.35, True, 3),
}


def _precise(label: str):
    return models.logistic(label, iterations=60).setTol(1e-9)


def _p_one() -> Column:
    """The probability of class 1 from a prediction and its certainty."""
    return F.round(F.when(F.col("prediction") == 1, F.col("score")).otherwise(1 - F.col("score")), 4)


@query(
    """
    WITH l AS (
        SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey, l_returnflag, 'q' || quarter(l_shipdate) AS season,
            CAST(l_discount >= 0.08 AS INT) AS label FROM lineitem),
    one AS (SELECT * FROM l WHERE l_orderkey IN (
        SELECT l_orderkey FROM l GROUP BY 1 HAVING min(l_returnflag) = max(l_returnflag))),
    base AS (SELECT 'all' AS pool, * FROM l UNION ALL SELECT 'one', * FROM one),
    sizes AS (SELECT pool, label, count(*) AS n FROM base GROUP BY 1, 2),
    times AS (SELECT pool, label, CAST(floor(max(n) OVER (PARTITION BY pool) / n) AS BIGINT) AS times FROM sizes),
    up AS (SELECT base.*, unnest(range(times)) AS copy FROM base JOIN times USING (pool, label)),
    ranked AS (SELECT 'all cut' AS pool, *, 0 AS copy FROM l UNION ALL SELECT 'one up cut', * EXCLUDE (pool) FROM up WHERE pool = 'one'),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY pool, label ORDER BY md5(id::VARCHAR), id) AS rn FROM ranked),
    least AS (SELECT pool, min(n) AS n FROM (SELECT pool, label, count(*) AS n FROM ranked GROUP BY 1, 2) GROUP BY 1),
    cut AS (SELECT numbered.* FROM numbered JOIN least USING (pool) WHERE rn <= least.n),
    trained AS (
        SELECT unnest(['plain', 'scaled', 'components']) AS variant, season, label, 1.0 AS w FROM l
        UNION ALL SELECT 'single_carrier', season, label, 1.0 FROM one
        UNION ALL SELECT 'upsampled', season, label, 1.0 FROM up WHERE pool = 'all'
        UNION ALL SELECT 'balanced', season, label, 1.0 FROM cut WHERE pool = 'all cut'
        UNION ALL SELECT 'weighted', season, label, CASE WHEN label = 1 THEN 0.35 ELSE 1.0 END FROM l
        UNION ALL SELECT 'together', season, label, CASE WHEN label = 1 THEN 0.35 ELSE 1.0 END FROM cut WHERE pool = 'one up cut'),
    shares AS (SELECT variant, season, round((sum(w * label) / sum(w))::DOUBLE, 4) AS p_one FROM trained GROUP BY 1, 2)
    SELECT variant, season, count(*) AS n_scored, p_one FROM l JOIN shares USING (season) GROUP BY variant, season, p_one
    """
)
def switched_training(spark: SparkSession, folder: str) -> DataFrame:
    """A training by every switch and by all of them together; all rows are scored by each model."""
    season = F.concat(F.lit("q"), F.quarter("l_shipdate").cast("string"))
    rows = parquet_table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        "l_orderkey",
        "l_returnflag",
        season.alias("season"),
        (F.col("l_discount") >= 0.08).cast("int").alias("label"),
    )
    rows = durable(rows, "lines")

    single = models.single_carrier_rows(rows, "label", "l_orderkey", "l_returnflag")

    def fit(variant: str):
        return models.train_switched(
            rows, "label", "id", [], ["season"], _VARIANTS[variant], _precise("label"), "l_orderkey", "l_returnflag", single
        )

    trained = models.fit_each(spark, _VARIANTS, fit)
    scored = models.score_each(rows.select("season"), trained, ["season"])
    # All eight predictions are counted together, and rounding costs more than counting, so it comes after.
    counted = scored.groupBy("season", *trained).agg(F.count("*").alias("n"))
    each = F.array(*[F.struct(F.lit(v).alias("variant"), F.col(v).prediction, F.col(v).score) for v in trained])
    apart = counted.select("season", "n", F.inline(each))
    return apart.groupBy("variant", "season", _p_one().alias("p_one")).agg(F.sum("n").alias("n_scored"))


@query(
    """
    SELECT *, CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction, round(greatest(p, 1 - p), 4) AS score FROM customer
    JOIN (SELECT c_mktsegment, avg(CAST(c_acctbal < 3500 AS INT)) AS p FROM customer GROUP BY 1) USING (c_mktsegment)
    """.replace("SELECT *,", "SELECT * EXCLUDE (p),", 1)
)
def line_scoring_job(spark: SparkSession, folder: str) -> DataFrame:
    """Scoring end to end: a stored model, records that come as lines, stored predictions, and every record beside its own."""
    customer = parquet_table(spark, folder, "customer")
    rows = customer.withColumn("label", (F.col("c_acctbal") < 3500).cast("int"))
    base = scratch_path(spark, "churn")
    model = models.train_switched(rows, "label", "c_custkey", [], ["c_mktsegment"], models.Switches(), _precise("label"))
    save_model(model, base, "all", "churn", "200106")
    lines = put(customer, base, "input/200107", "csv")
    latest = models.latest_model(spark, base, "all", "churn", "200107")
    scored = models.score_lines(spark, lines, customer.schema, latest, "c_custkey", base, "output/200107")
    return scored.withColumn("score", F.round("score", 4))


_REGION_ORDERS_SQL = """(
    SELECT o_orderkey, r_name AS market, o_orderpriority, o_orderdate >= TIMESTAMP '2001-01-01' AS now,
        CAST(o_totalprice >= 250000 AS INT) AS label
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)"""


@query(
    f"""
    WITH o AS (SELECT * FROM {_REGION_ORDERS_SQL}),
    own AS (SELECT market, o_orderpriority, avg(label) AS p FROM o WHERE now AND market IN ('AMERICA', 'ASIA', 'EUROPE') GROUP BY 1, 2),
    old AS (SELECT o_orderpriority, avg(label) AS p FROM o WHERE NOT now GROUP BY 1)
    SELECT o_orderkey, market, round(coalesce(own.p, old.p), 4) AS p_one
    FROM o LEFT JOIN own USING (market, o_orderpriority) JOIN old USING (o_orderpriority) WHERE now
    """
)
def historical_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """This period's orders, scored by their market's model or, in markets without training, by the last stored one of an earlier period."""
    orders = parquet_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    nation = parquet_table(spark, folder, "nation").join(
        parquet_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customer = parquet_table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    users = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    labelled = orders.join(users, "o_custkey").select(
        "o_orderkey",
        F.col("r_name").alias("market"),
        "o_orderpriority",
        (F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp")).alias("now"),
        (F.col("o_totalprice") >= 250000).cast("int").alias("label"),
    )
    rows = durable(labelled, "orders")
    pipeline = models.assembled([], _precise("label"), ["o_orderpriority"])
    base = scratch_path(spark, "models")
    # The earlier run leaves its model behind, this one finds it.
    save_model(models.train(rows.where("not now"), pipeline), base, "all", "price", "200012")
    historical = models.latest_model(spark, base, "all", "price", "200101")
    now = rows.where("now")
    trained = models.train_markets(now, ["AMERICA", "ASIA", "EUROPE"], pipeline)
    return models.score_markets(now, trained, historical).select("o_orderkey", "market", _p_one().alias("p_one"))
