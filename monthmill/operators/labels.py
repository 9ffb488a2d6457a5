"""Labels of users: taken from the market's own list, or voted for by the apps that tell classes apart.

How labels are made is a choice of ours: the jobs followed here name the two
routes, their order (the own labels come first) and their outputs only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from monthmill.operators.routing import label_source
from monthmill.session import durable, small_side


def own_labels(known: DataFrame, kinds: list[str], user: str = "user_id") -> DataFrame:
    """``user, model_type, label`` from a list with a column per type; missing labels are left out."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("model_type"), F.col(k).cast("int").alias("label")) for k in kinds]))
    return known.select(user, each.alias("one")).select(user, "one.*").where(F.col("label").isNotNull())


def accurate_apps(usage: DataFrame, labels: DataFrame, share: float, users: int, user: str = "user_id", app: str = "app") -> DataFrame:
    """``app, model_type, label, n_users``: apps of whose labelled users at least ``share`` are of one class.

    An app needs ``users`` labelled users. A user counts once per app. The
    smaller label wins a tie.
    """
    seen = usage.select(user, app).where(F.col(app).isNotNull()).distinct().join(labels, user)
    counted = seen.groupBy(app, "model_type", "label").agg(F.count("*").alias("n"))
    best = F.max(F.struct("n", (-F.col("label")).alias("back"))).alias("best")
    apps = counted.groupBy(app, "model_type").agg(best, F.sum("n").alias("n_users"))
    fits = (F.col("n_users") >= users) & (F.col("best.n") >= F.col("n_users") * share)
    return apps.where(fits).select(app, "model_type", (-F.col("best.back")).alias("label"), "n_users")


def voted_labels(usage: DataFrame, apps: DataFrame, user: str = "user_id", app: str = "app") -> DataFrame:
    """``user, model_type, label, votes, n_votes``: the class that most accurate apps of a user stand for.

    The list of apps is stored and broadcast if its size allows. Users without
    an accurate app have no label. The smaller label wins a tie.
    """
    held = small_side(durable(apps.select(app, "model_type", "label"), "accurate-apps"))
    votes = usage.select(user, app).distinct().join(held, app).groupBy(user, "model_type", "label").agg(F.count("*").alias("n"))
    best = F.max(F.struct("n", (-F.col("label")).alias("back"))).alias("best")
    ranked = votes.groupBy(user, "model_type").agg(best, F.sum("n").alias("n_votes"))
    return ranked.select(user, "model_type", (-F.col("best.back")).alias("label"), F.col("best.n").alias("votes"), "n_votes")


def market_labels(usage: DataFrame, known: DataFrame, users: DataFrame, kinds: list[str], share: float = 0.6, least_users: int = 3, user: str = "user_id", app: str = "app", market: str = "market") -> DataFrame:
    """``user, market, label_source, model_type, label`` of all markets that have labels.

    ``known`` lists the labels of users of the markets with labels of their
    own; from them the accurate apps are found, which label the users of the
    markets on the shared route. Markets without a route have no rows.
    """
    routed = users.select(user, market, label_source(F.col(market)).alias("label_source")).where(F.col("label_source").isNotNull())
    own = own_labels(known, kinds, user).join(routed.where("label_source = 'own'"), user)
    own = durable(own.select(user, market, "label_source", "model_type", "label"), "own-labels")
    apps = accurate_apps(usage, own.select(user, "model_type", "label"), share, least_users, user, app)
    shared = voted_labels(usage.join(routed.where("label_source = 'shared'"), user), apps, user, app)
    return own.unionByName(shared.join(routed, user).select(user, market, "label_source", "model_type", "label"))
