"""Markets, their model routes and settings, and the jobs of a monthly cycle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from monthmill.functions.names import job_name

# Markets and their size class.
MARKET_SIZES = {
    "MY": "large",
    "TH": "large",
    "PH": "large",
    "ID": "large",
    "SG": "large",
    "LK": "large",
    "BD": "large",
    "KH": "large",
    "MM": "large",
}

# Which market takes which route.
OWN_LABEL_MARKETS = ["MY"]
SHARED_LABEL_MARKETS = ["SG", "PH", "TH", "BD", "ID"]
FIRST_VARIANT_MARKETS = ["MY", "TH", "ID"]
SECOND_VARIANT_MARKETS = ["BD", "PH", "SG"]
MODEL_TYPES = ["age", "gender"]

# Executors, cores and memory of a size class.
SIZE_SETTINGS = {
    "large": {"num_executors": 59, "driver_memory": "32G", "driver_cores": 5, "executor_memory": "32G", "executor_cores": 5},
    "small": {"num_executors": 14, "driver_memory": "32G", "driver_cores": 5, "executor_memory": "32G", "executor_cores": 5},
}


def market_table(spark: SparkSession, sizes: dict[str, str] | None = None) -> DataFrame:
    """``market, size`` of the configured markets."""
    return spark.createDataFrame(list((sizes or MARKET_SIZES).items()), "market string, size string")


def settings_table(spark: SparkSession, settings: dict[str, dict] | None = None) -> DataFrame:
    """``size`` and its settings, one row per size class."""
    rows = [{"size": size, **values} for size, values in (settings or SIZE_SETTINGS).items()]
    schema = (
        "size string, num_executors int, driver_memory string, driver_cores int,"
        " executor_memory string, executor_cores int"
    )
    return spark.createDataFrame(rows, schema)


def with_settings(markets: DataFrame, settings: DataFrame, size: str = "size") -> DataFrame:
    """Every market with the settings of its size class. A size without settings stops the job."""
    known = settings.withColumn("_known", F.lit(True))
    unknown = F.raise_error(F.format_string("no settings for size %s", F.col(size))).cast("boolean")
    # A filter, since a checked column would be dropped with its check if nobody reads it.
    joined = markets.join(known, size, "left").where(F.when(F.col("_known"), True).otherwise(unknown))
    return joined.drop("_known")


def label_source(market: Column) -> Column:
    """``own``, ``shared``, or NULL where a market has no labels."""
    return F.when(market.isin(OWN_LABEL_MARKETS), "own").when(market.isin(SHARED_LABEL_MARKETS), "shared")


def model_variant(market: Column) -> Column:
    """``v1``, ``v2``, or ``fallback`` where a market has no training."""
    return (
        F.when(market.isin(FIRST_VARIANT_MARKETS), "v1")
        .when(market.isin(SECOND_VARIANT_MARKETS), "v2")
        .otherwise("fallback")
    )


def routes(df: DataFrame, market: str = "market") -> DataFrame:
    """Add the label source and the model variant of each market."""
    return df.withColumn("label_source", label_source(F.col(market))).withColumn(
        "variant", model_variant(F.col(market))
    )


def with_model_types(df: DataFrame, types: list[str] | None = None) -> DataFrame:
    """Each row once per model type."""
    kinds = F.array(*[F.lit(t) for t in types or MODEL_TYPES])
    return df.withColumn("model_type", F.explode(kinds))


def manifest(markets: DataFrame, market: str = "market", month: str = "data_month") -> DataFrame:
    """Label, train and predict jobs of all markets and months as one list.

    Markets with labels get a label job; markets with a trained variant get a
    training job per model type; every market gets a prediction job per type.
    Each market and month is read once and unfolds into its jobs.
    """
    at, when_, variant = F.col(market), F.col(month), F.col("variant")

    def job(step: str, route: Column, model_type: str | None = None) -> Column:
        kind = F.lit(model_type).cast("string")
        name = job_name(step, at, when_, kind if model_type else None)
        return F.struct(
            F.lit(step).alias("step"), kind.alias("model_type"), route.alias("route"), name.alias("job")
        )

    jobs = [job("label", F.col("label_source"))]
    jobs += [job("train", F.when(variant != "fallback", variant), kind) for kind in MODEL_TYPES]
    jobs += [job("predict", variant, kind) for kind in MODEL_TYPES]
    due = F.filter(F.array(*jobs), lambda j: j["route"].isNotNull())
    listed = routes(markets.select(market, month), market).select(market, month, F.inline(due))
    return listed.select("step", market, "model_type", month, "route", "job")
