"""Rating statistics, tags and the rating-based lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import contains_ci, year_month
from .relational import top_n_per_group

# The genre list.
GENRES = [
    "Action", "Adventure", "Animation", "Comedy", "Crime", "Documentary", "Drama", "Family",
    "Fantasy", "Foreign", "History", "Horror", "Music", "Mystery", "Romance", "Science", "Tv",
    "Thriller", "War", "Western",
]


def rating_counts(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("mid").agg(F.count("mid").alias("count"))


def rating_counts_by_month(ratings: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Ratings per (yyyyMM, item), latest month first."""
    return (
        ratings.select("mid", year_month(F.col(ts_col)).alias("yearOfMonth"))
        .groupBy("yearOfMonth", "mid")
        .agg(F.count("mid").alias("count"))
        .orderBy(F.desc("yearOfMonth"), F.desc("mid"))
        .select("mid", "count", "yearOfMonth")
    )


def average_scores(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("mid").agg(F.avg("score").alias("avg"))


def tags_per_item(tags: DataFrame) -> DataFrame:
    """Distinct tags of each item, sorted, joined by ``|``.

    Repeats go in a first aggregate, so only distinct (item, tag) pairs reach the list.
    """
    distinct = tags.select("mid", "tag").distinct()
    return distinct.groupBy("mid").agg(
        F.concat_ws("|", F.array_sort(F.collect_list("tag"))).alias("tags")
    )


def movies_with_tags(movies: DataFrame, tags: DataFrame) -> DataFrame:
    """Every movie with its joined tags, null where it has none."""
    return movies.join(tags_per_item(tags), "mid", "left")


def genre_top_n(movies: DataFrame, ratings: DataFrame, genres: list[str] = GENRES, n: int = 10) -> DataFrame:
    """(genre, rank, mid, avg): best-rated movies whose genre text contains each genre name.

    The containment test runs inside the movie row, so no movie meets a genre it does not have.
    """
    named = F.array(*[F.when(contains_ci(F.col("genres"), g), F.lit(g)) for g in genres])
    scored = movies.select("mid", "genres").join(average_scores(ratings), "mid")
    per_genre = scored.select(F.explode(F.array_compact(named)).alias("genre"), "mid", "avg")
    return top_n_per_group(per_genre, "genre", [F.desc("avg"), F.asc("mid")], n)


def recent_ratings(ratings: DataFrame, k: int = 20, ts_col: str = "timestamp") -> DataFrame:
    """The k latest ratings of each user, newest first; ties go to the larger item id."""
    return top_n_per_group(ratings, "uid", [F.desc(ts_col), F.desc("mid")], k)
