"""Training data preparation, model jobs and their measures."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from monthmill.operators import features, grouped, metrics, models, prep, trees
from monthmill.plans.registry import query
from monthmill.plans.stand_ins import MARKET_SQL, REFERENCE_MONTH, REQUEST_ORDER, market_code
from monthmill.session import durable, scratch_path
from monthmill.sinks.files import save_model
from monthmill.sources.tables import parquet_table

_METRIC_SQL = """(
    SELECT event_id, event_type, value, CAST(value >= 250 AS INT) AS prediction, CAST(hour(ts) >= 12 AS INT) AS label
    FROM events)"""


def _scored_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as scored rows: the value is the score, the half of the day the label."""
    return parquet_table(spark, folder, "events").select(
        "event_id",
        "event_type",
        "value",
        (F.col("value") >= 250).cast("int").alias("prediction"),
        (F.hour("ts") >= 12).cast("int").alias("label"),
    )


@query(
    """
    SELECT o_orderkey, round((o_totalprice - s.m) / s.d, 6) AS o_totalprice_std,
        round((o_totalprice - s.lo) / (s.hi - s.lo), 6) AS o_totalprice_norm
    FROM orders CROSS JOIN (
        SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS d, min(o_totalprice) AS lo, max(o_totalprice) AS hi
        FROM orders) AS s
    """
)
def scaled(spark: SparkSession, folder: str) -> DataFrame:
    """Standard and min-max scaling of a column."""
    orders = parquet_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    both = prep.minmax_scale(prep.standard_scale(orders, ["o_totalprice"]), ["o_totalprice"])
    return both.select("o_orderkey", *[F.round(c, 6).alias(c) for c in ["o_totalprice_std", "o_totalprice_norm"]])


@query(
    """
    WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality)
    SELECT doc_id, quality, unnest(range(1, CAST(floor((SELECT max(n) FROM c) / c.n) AS BIGINT) + 1))::INT AS copy
    FROM labels JOIN c USING (quality)
    """
)
def upsampled(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of small classes repeated."""
    labels = parquet_table(spark, folder, "labels").select("doc_id", "quality")
    return prep.upsample(labels, "quality")


@query(
    """
    WITH r AS (
        SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id::VARCHAR), doc_id) AS rn
        FROM labels)
    SELECT doc_id, quality FROM r
    WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM labels GROUP BY quality))
    """
)
def balanced(spark: SparkSession, folder: str) -> DataFrame:
    """Every class cut to the size of the smallest."""
    labels = parquet_table(spark, folder, "labels").select("doc_id", "quality")
    return prep.balance(labels, "quality", "doc_id")


@query(
    """
    SELECT o_orderkey, o_orderpriority FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(o_orderkey::VARCHAR), o_orderkey) AS rn
        FROM orders) WHERE rn <= 100
    """
)
def picked_per_class(spark: SparkSession, folder: str) -> DataFrame:
    """The same number of rows of each class, always the same ones."""
    orders = parquet_table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return prep.pick_per_class(orders, "o_orderpriority", "o_orderkey", 100)


@query(
    """
    SELECT doc_id, quality, CASE WHEN quality = 1 THEN 0.35 ELSE 1.0 END::DOUBLE AS weight FROM labels
    """
)
def pos_weight(spark: SparkSession, folder: str) -> DataFrame:
    """Weights of the positive class."""
    return prep.with_class_weight(parquet_table(spark, folder, "labels").select("doc_id", "quality"), "quality")


@query(
    """
    SELECT doc_id, quality,
        CASE WHEN ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 100 < 80 THEN 'train' ELSE 'test' END AS part
    FROM labels
    """
)
def train_test(spark: SparkSession, folder: str) -> DataFrame:
    """A split that depends on the id alone."""
    return prep.with_split(parquet_table(spark, folder, "labels").select("doc_id", "quality"), "doc_id")


@query(
    f"""
    SELECT event_type, decile, count(*) AS n, round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy
    FROM (SELECT *, CAST(ntile(10) OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS INT) AS decile
        FROM {_METRIC_SQL}) GROUP BY event_type, decile
    """
)
def decile_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy per group and score decile."""
    measured = metrics.decile_accuracy(
        _scored_events(spark, folder), ["event_type"], "value", "event_id", "prediction", "label"
    )
    return measured.withColumn("accuracy", F.round("accuracy", 6))


@query(
    f"""
    SELECT event_id, event_type, CAST(ntile(10) OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS INT) AS decile
    FROM {_METRIC_SQL}
    """
)
def score_deciles(spark: SparkSession, folder: str) -> DataFrame:
    """The decile of every scored row."""
    rows = _scored_events(spark, folder).select("event_id", "event_type", "value")
    return metrics.with_tiles(rows, ["event_type"], "value", "event_id").drop("value")


@query(
    f"""
    SELECT *, CASE WHEN accuracy >= 0.5 THEN 'accurate' ELSE 'inaccurate' END AS branch FROM (
        SELECT event_type, count(*) AS n, round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy
        FROM {_METRIC_SQL} GROUP BY event_type)
    """
)
def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy of predictions against a threshold."""
    gated = metrics.quality_gate(_scored_events(spark, folder), ["event_type"], "prediction", "label", 0.5)
    return gated.withColumn("accuracy", F.round("accuracy", 6))


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors with an age label of ten classes and a gender label of two, and the split."""
    rows = parquet_table(spark, folder, "embeddings").select(
        "vec_id",
        array_to_vector("embedding").alias("features"),
        F.col("label").cast("double").alias("age"),
        (F.col("label") >= 5).cast("double").alias("gender"),
    )
    return prep.with_class_weight(prep.with_split(rows, "vec_id"), "gender")


def _report(scored: DataFrame, *kept: str) -> DataFrame:
    return scored.select(*kept, "prediction", F.round("score", 3).alias("score"))


@query()
def pca(spark: SparkSession, folder: str) -> DataFrame:
    """The first three principal components of every vector."""
    scores, _ = prep.principal_components(_vectors(spark, folder).select("vec_id", "features"), "features", 3)
    return scores.drop("features")


@query(
    """
    SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]), 4) AS squared_length
    FROM embeddings
    """
)
def pca_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """All principal components together keep the length of every vector."""
    rows = parquet_table(spark, folder, "embeddings")
    width = len(rows.select("embedding").first()[0])
    vectors = rows.select("vec_id", array_to_vector("embedding").alias("features"))
    scores, _ = prep.principal_components(vectors, "features", width)
    squares = [F.col(f"pc_{i + 1}") * F.col(f"pc_{i + 1}") for i in range(width)]
    length = F.aggregate(F.array(*squares), F.lit(0.0), lambda a, b: a + b)
    return scores.select("vec_id", F.round(length, 4).alias("squared_length"))


@query()
def train_score_lr(spark: SparkSession, folder: str) -> DataFrame:
    """Logistic regression for age, trained on the training part, scored on all rows."""
    rows = _vectors(spark, folder)
    model = models.train(rows.where(F.col("part") == "train"), models.logistic("age"))
    return _report(models.score(rows, model), "vec_id", "part", "age")


@query()
def train_score_gbt(spark: SparkSession, folder: str) -> DataFrame:
    """Weighted boosted trees for gender, trained on the training part, scored on all rows."""
    rows = _vectors(spark, folder)
    trees = models.boosted("gender", weight="weight")
    model = models.train(rows.where(F.col("part") == "train"), trees)
    return _report(models.score(rows, model), "vec_id", "part", "gender")


# The market segments of the customers.
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_TRAINED_MARKETS = ["AMERICA", "ASIA", "EUROPE"]


def _churn_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Users' features, the label of the next month and the market, here the region."""
    orders = parquet_table(spark, folder, "orders")
    month = features.month_shift(REFERENCE_MONTH, -1)
    known = features.request_features(orders, "o_custkey", REQUEST_ORDER, "o_orderpriority", month)
    labelled = features.churn_labels(orders, known, "o_custkey", "o_orderdate", month)
    nation = parquet_table(spark, folder, "nation").join(
        parquet_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customer = parquet_table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    users = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return labelled.join(users.select("o_custkey", F.col("r_name").alias("market")), "o_custkey")


@query()
def market_models(spark: SparkSession, folder: str) -> DataFrame:
    """The monthly cycle: features, next month's labels, one model per market, and the stored
    historical model for markets without training."""
    rows = durable(_churn_rows(spark, folder))
    numbers = [f"{c}_p_{k}" for k in range(features.PERIODS) for c in ("brq_count", "num_days")] + ["n_switches"]
    pipeline = models.assembled(numbers, models.logistic("is_churn"), ["carrier"])
    base = scratch_path(spark, "models")
    month = REFERENCE_MONTH.strftime("%Y%m")
    save_model(models.train(rows, pipeline), base, "all", "churn", month)
    historical = models.stored_model(base, "all", "churn", month)
    trained = models.train_markets(rows, _TRAINED_MARKETS, pipeline)
    scored = models.score_markets(rows, trained, historical)
    return scored.select("o_custkey", "market", "is_churn", "prediction", F.round("score", 3).alias("score"))


@query(
    """
    SELECT c_custkey AS o_custkey, r_name AS market FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    WHERE c_custkey IN (
        SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderdate < TIMESTAMP '2001-07-01')
    """
)
def fallback_score(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of a stored historical model beside their inputs; every input row comes back once."""
    rows = durable(_churn_rows(spark, folder))
    numbers = [f"{c}_p_{k}" for k in range(features.PERIODS) for c in ("brq_count", "num_days")] + ["n_switches"]
    base = scratch_path(spark, "models")
    pipeline = models.assembled(numbers, models.logistic("is_churn"), ["carrier"])
    save_model(models.train(rows, pipeline), base, "all", "churn", "200107")
    scored = models.score(rows, models.stored_model(base, "all", "churn", "200107"))
    return scored.where(F.col("prediction").isin(0.0, 1.0)).select("o_custkey", "market")


@query(
    """
    SELECT c_custkey, round(avg(CASE WHEN c_acctbal >= 5000 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY c_mktsegment), 4) AS p_rich
    FROM customer
    """
)
def logistic_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Logistic regression on the indicators of one category: its probabilities are the shares of the categories."""
    rows = parquet_table(spark, folder, "customer").select(
        "c_custkey",
        *[(F.col("c_mktsegment") == s).cast("double").alias(s) for s in _SEGMENTS],
        (F.col("c_acctbal") >= 5000).cast("double").alias("rich"),
    )
    estimator = models.logistic("rich", iterations=200).setTol(1e-12).setFitIntercept(False)
    scored = models.score(rows, models.train(rows, models.assembled(_SEGMENTS, estimator)))
    p_rich = F.when(F.col("prediction") == 1, F.col("score")).otherwise(1 - F.col("score"))
    return scored.select("c_custkey", F.round(p_rich, 4).alias("p_rich"))


@query(
    """
    WITH v AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings),
    m AS (SELECT var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS c FROM v),
    e AS (SELECT b AS p, (c - a) / 2 + sqrt((a - c) * (a - c) / 4 + b * b) AS q FROM m)
    SELECT vec_id, round(abs(x * p + y * q) / sqrt(p * p + q * q), 6) AS along, round(abs(y * p - x * q) / sqrt(p * p + q * q), 6) AS across
    FROM v, e
    """
)
def pca_plane(spark: SparkSession, folder: str) -> DataFrame:
    """Both principal components of two columns, without their arbitrary signs."""
    two = F.slice("embedding", 1, 2).cast("array<double>")
    vectors = parquet_table(spark, folder, "embeddings").select("vec_id", array_to_vector(two).alias("features"))
    scores, _ = prep.principal_components(vectors, "features", 2)
    return scores.select("vec_id", F.round(F.abs("pc_1"), 6).alias("along"), F.round(F.abs("pc_2"), 6).alias("across"))


_PEOPLE_SQL = f"""(
    SELECT c_custkey, c_mktsegment, c_nationkey, {MARKET_SQL} AS market, CAST(c_acctbal >= 5000 AS INT) AS rich,
        CASE WHEN c_acctbal < 2500 THEN 0 WHEN c_acctbal < 6000 THEN 1 ELSE 2 END AS age
    FROM customer)"""


def _people(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their market, a label of two classes and one of three."""
    money = F.col("c_acctbal")
    return parquet_table(spark, folder, "customer").select(
        "c_custkey",
        "c_mktsegment",
        "c_nationkey",
        market_code(F.col("c_nationkey")).alias("market"),
        (money >= 5000).cast("int").alias("rich"),
        F.when(money < 2500, 0).when(money < 6000, 1).otherwise(2).alias("age"),
    )


@query(
    f"""
    WITH rows AS (
        SELECT market, c_mktsegment, 'rich' AS model_type, rich AS label FROM {_PEOPLE_SQL}
        UNION ALL SELECT market, c_mktsegment, 'age', age FROM {_PEOPLE_SQL}),
    trained AS (SELECT market, model_type FROM rows GROUP BY 1, 2 HAVING count(DISTINCT label) > 1),
    everywhere AS (
        SELECT c_mktsegment, model_type, avg(CAST(label = 1 AS INT)) AS share FROM rows GROUP BY 1, 2)
    SELECT market, c_mktsegment, model_type, t.market IS NOT NULL AS own_model, count(*) AS n,
        round(CASE WHEN t.market IS NOT NULL THEN sum(CAST(label = 1 AS INT)) ELSE sum(share) END, 2)::DOUBLE AS expected
    FROM rows JOIN everywhere USING (c_mktsegment, model_type) LEFT JOIN trained AS t USING (market, model_type)
    GROUP BY 1, 2, 3, 4
    """
)
def grouped_shares(spark: SparkSession, folder: str) -> DataFrame:
    """All markets fitted at once on the indicators of one category: the probabilities of class 1 add up to its rows.

    Markets that show one class only are scored by the model over all.
    """
    people = _people(spark, folder)
    values = {"c_mktsegment": _SEGMENTS}
    rows = people.withColumn("features", grouped.features_of(people, [], values))
    fitted = grouped.fit_groups(rows, "features", {"rich": 2, "age": 3}, penalty=0.0, rounds=20)
    scored = grouped.score_groups(rows, grouped.model_table(spark, fitted), "features")
    cells = scored.groupBy("market", "c_mktsegment", "model_type", (F.col("model") != grouped.EVERY).alias("own_model"))
    return cells.agg(F.count("*").alias("n"), F.round(F.sum(F.col("probabilities")[1]), 2).alias("expected"))


@query(
    f"""
    WITH trained AS (SELECT market FROM {_PEOPLE_SQL} GROUP BY 1 HAVING count(DISTINCT rich) > 1)
    SELECT market, c_mktsegment, count(*) AS n, sum(rich)::DOUBLE AS expected
    FROM {_PEOPLE_SQL} JOIN trained USING (market) GROUP BY 1, 2
    """
)
def leafwise_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Boosted trees with a leaf per value of one feature, round after round: the probabilities add up to the rows of class 1."""
    place = F.array_position(F.array(*[F.lit(s) for s in _SEGMENTS]), F.col("c_mktsegment"))
    rows = _people(spark, folder).withColumn("features", F.array(place.cast("double")))
    settings = trees.Settings(rounds=80, rate=0.2, least_rows=1)
    scored = trees.score_trees(rows, trees.fit_trees(rows, "features", {"rich": 2}, settings=settings), "features")
    return scored.groupBy("market", "c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum(F.col("probabilities")[1]), 1).alias("expected"))


@query(
    f"""
    WITH rows AS (SELECT c_custkey, c_nationkey AS x, rich::DOUBLE AS y FROM {_PEOPLE_SQL}),
    base AS (SELECT avg(y) AS p, count(*) AS n FROM rows),
    cuts AS (
        SELECT t.x AS cut, count(*) FILTER (rows.x <= t.x) AS n, sum(p - y) FILTER (rows.x <= t.x) AS g
        FROM rows, (SELECT DISTINCT x FROM rows WHERE x < (SELECT max(x) FROM rows)) AS t, base GROUP BY 1),
    best AS (SELECT cut FROM cuts, base WHERE cuts.n >= 20 AND base.n - cuts.n >= 20
        ORDER BY round(g * g / cuts.n + g * g / (base.n - cuts.n), 6) DESC, cut LIMIT 1),
    leaf AS (SELECT x <= cut AS low, sum(y - p) / (count(*) * any_value(p * (1 - p))) AS v FROM rows, base, best GROUP BY 1)
    SELECT c_custkey, x <= cut AS low, round(1 / (1 + exp(-(ln(p / (1 - p)) + v))), 4) AS p_rich
    FROM rows, base, best JOIN leaf ON low = (x <= cut)
    """
)
def leafwise_split(spark: SparkSession, folder: str) -> DataFrame:
    """One round of one tree with two leaves: the split with the greatest gain and a Newton step in each leaf."""
    rows = _people(spark, folder).withColumn("features", F.array(F.col("c_nationkey").cast("double"))).withColumn("market", F.lit("all"))
    model = trees.fit_trees(rows, "features", {"rich": 2}, settings=trees.Settings(rounds=1, leaves=2, rate=1.0))[0]
    cut = float(model.edges[0][model.trees[0][0].bin[0]])
    scored = trees.score_trees(rows, [model], "features")
    return scored.select("c_custkey", (F.col("c_nationkey") <= cut).alias("low"), F.round(F.col("probabilities")[1], 4).alias("p_rich"))
