"""Online recommendation: candidates near the item just rated, re-scored by recent ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import lg
from ..session import stored
from .relational import top_n_per_group
from .similarity import ranked_members, sims_with_better

_SHELF = 16  # items of one profile that are fetched together


def parse_rating_events(df: DataFrame, col: str = "value") -> DataFrame:
    """``UID|MID|SCORE|TIMESTAMP`` text to typed columns; a malformed field becomes null."""
    parts = F.split(col, r"\|", -1)
    types = {"uid": "int", "mid": "int", "score": "double", "timestamp": "int"}
    return df.select(
        *[F.trim(F.get(parts, F.lit(i))).try_cast(t).alias(n) for i, (n, t) in enumerate(types.items())]
    )


def top_unseen_similar(
    events: DataFrame, ratings: DataFrame, sims: DataFrame, members: DataFrame, n: int = 20
) -> DataFrame:
    """(uid, mid, rank, candidate, profile, score): the n items most like the rated one that the
    user has not rated.  ``events`` has one (uid, mid) row per request; an item without known
    neighbours gives no rows.

    A user with s ratings needs at most the first n + s + 1 entries of a list to find n unseen
    ones, so only the items that can be among those are fetched, shelf by shelf.
    """
    requests = events.select("uid", "mid").distinct()
    seen = ratings.select("uid", F.col("mid").alias("candidate")).distinct()
    n_seen = seen.groupBy("uid").agg(F.count(F.lit(1)).alias("n_seen"))
    asked = (
        requests.join(n_seen, "uid", "left")
        .withColumn("need", F.coalesce("n_seen", F.lit(0)) + n + 1)
        .join(members.select("mid", "profile"), "mid")
    )
    near = (
        asked.join(sims_with_better(sims, members), "profile")
        .withColumn("first", F.col("need") - F.col("n_better"))
        .where(F.col("first") > 0)
    )
    last_shelf = F.call_function("div", F.col("first") - 1, F.lit(_SHELF))
    shelves = near.select(
        "uid", "mid", "first", "score", F.col("other_profile").alias("profile"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), last_shelf)).alias("shelf"),
    )
    stock = ranked_members(members).select(
        "profile",
        F.col("mid").alias("candidate"),
        "pos",
        F.call_function("div", F.col("pos"), F.lit(_SHELF)).alias("shelf"),
    )
    offered = shelves.join(stock, ["profile", "shelf"]).where(
        (F.col("pos") < F.col("first")) & (F.col("candidate") != F.col("mid"))
    )
    unseen = offered.join(seen, ["uid", "candidate"], "left_anti")
    return top_n_per_group(unseen, ["uid", "mid"], [F.desc("score"), F.asc("candidate")], n).select(
        "uid", "mid", "rank", "candidate", "profile", "score"
    )


def rescore(
    candidates: DataFrame,
    recent: DataFrame,
    sims: DataFrame,
    members: DataFrame,
    min_sim: float = 0.7,
    liked_above: float = 3.0,
) -> DataFrame:
    """(uid, mid, score) from candidates (uid, candidate, profile) and recent (uid, mid, score).

    Mean of similarity x rating over the recent items above min_sim, plus lg of how many of those
    were liked, minus lg of how many were not.  A candidate without such an item has no score.
    """
    rated = recent.join(members.select("mid", "profile"), "mid").select(
        "uid", F.col("mid").alias("seen_mid"), F.col("profile").alias("other_profile"),
        F.col("score").alias("rating"),
    )
    pairs = candidates.select("uid", "candidate", "profile").distinct().join(rated, "uid").where(
        F.col("candidate") != F.col("seen_mid")
    )
    strong = pairs.join(
        sims.where(F.col("score") > min_sim).withColumnRenamed("score", "sim"),
        ["profile", "other_profile"],
    )
    return (
        strong.groupBy("uid", F.col("candidate").alias("mid"))
        .agg(
            F.avg(F.col("sim") * F.col("rating")).alias("_base"),
            F.count_if(F.col("rating") > liked_above).alias("_ups"),
            F.count_if(F.col("rating") <= liked_above).alias("_downs"),
        )
        .select("uid", "mid", (F.col("_base") + lg(F.col("_ups")) - lg(F.col("_downs"))).alias("score"))
    )


def online_recs(
    events: DataFrame,
    ratings: DataFrame,
    sims: DataFrame,
    members: DataFrame,
    k_recent: int = 20,
    n: int = 20,
    ts_col: str = "timestamp",
) -> DataFrame:
    """Re-scored list per user for a batch of rating events; a user's latest event counts."""
    from .ratings import recent_ratings
    from .relational import keep_last

    last = keep_last(events.select("uid", "mid", ts_col), ["uid"], [ts_col])
    users = last.select("uid")
    own = ratings.join(users, "uid", "left_semi")
    # stored, so that the shuffle files of the search are gone before those of the scores come
    candidates = stored(top_unseen_similar(last, own, sims, members, n), "candidates")
    return rescore(candidates, recent_ratings(own, k_recent, ts_col), sims, members)
