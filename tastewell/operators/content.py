"""The content model: item text, TF-IDF vectors, user profiles, top lists, predictions.

Vectors are sparse throughout, as parallel ``idx`` and ``val`` arrays: a row costs what its
words cost, not what the dimension costs. The only dense arrays are small numpy blocks inside
the scoring tasks.
"""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastewell.constants import (
    AVERAGE_WEIGHT,
    DEFAULT_RATING,
    LIKE_THRESHOLD,
    LIST_SIZE,
    MAX_SCORE,
    NO_GENRES,
    QUALITY_MIN_AVERAGE,
    QUALITY_MIN_VOTES,
    TAGS_PER_MOVIE,
    TEXT_DIMENSIONS,
)
from tastewell.functions.genres import genre_text
from tastewell.functions.ranking import top_per_key
from tastewell.functions.scores import norm, similarity_rating, sparse_dot
from tastewell.operators.scoring import SCORE_DECIMALS, top_by_passes
from tastewell.session import written

# Bound of what one scoring pass ships to every executor: 5,000 x 512 doubles are 20 MB.
CANDIDATES_PER_PASS = 5000


def movie_tags_text(tags: DataFrame, limit: int = TAGS_PER_MOVIE) -> DataFrame:
    """The first tags of each movie (by time, user, tag) as one text, for display.

    Salted: one movie may hold any share of all tags. The list itself has at most ``limit``
    entries; the model counts all tags, see ``content_rows``.
    """
    order = [F.asc("ts"), F.asc("userId"), F.asc("tag")]
    first = top_per_key(tags, ["movieId"], order, limit, "place", salts=16)
    ordered = F.sort_array(F.collect_list(F.struct("place", "tag")))
    return first.groupBy("movieId").agg(
        F.concat_ws(" ", F.transform(ordered, lambda t: t["tag"])).alias("tags_text")
    )


def movie_content(
    movies: DataFrame, tags: DataFrame | None = None, without_genres_as_text: bool = True
) -> DataFrame:
    """Genres and tags of each movie as one text.

    ``without_genres_as_text`` keeps the words of the "no genres" marker, as the original
    content does.
    """
    genres = genre_text(F.col("genres"))
    if not without_genres_as_text:
        genres = F.when(F.col("genres") == NO_GENRES, "").otherwise(genres)
    base = movies.select("movieId", genres.alias("genres_text"))
    if tags is None:
        return base.select("movieId", F.col("genres_text").alias("content"))
    return base.join(movie_tags_text(tags), "movieId", "left").select(
        "movieId",
        F.concat_ws(" ", "genres_text", F.coalesce("tags_text", F.lit(""))).alias("content"),
    )


def content_rows(movies: DataFrame, tags: DataFrame | None = None) -> DataFrame:
    """The pieces of each movie's content, ``movieId, content``: its genres, and each of its tags.

    All tags count, and no movie's tags are ever gathered in one row. A movie without any genre or
    tag has a piece without words; one with tags but no genre has an empty first word, as in its
    joined text.
    """
    genres = movies.select("movieId", genre_text(F.col("genres")).alias("content"))
    if tags is None:
        return genres
    tagged = tags.select(F.col("movieId").alias("tagged")).distinct()
    empty = (F.col("content") == "") & F.col("tagged").isNull()
    head = genres.join(tagged, F.col("movieId") == F.col("tagged"), "left").select(
        "movieId", F.when(empty, " ").otherwise(F.col("content")).alias("content")
    )
    known = tags.join(movies.select("movieId"), "movieId", "left_semi")
    return head.unionByName(known.select("movieId", F.col("tag").alias("content")))


def _terms(content: DataFrame) -> DataFrame:
    """Content with its ``terms``: words without stop words."""
    words = Tokenizer(inputCol="content", outputCol="words").transform(content)
    return StopWordsRemover(inputCol="words", outputCol="terms").transform(words)


def item_vectors(content: DataFrame, dimensions: int = TEXT_DIMENSIONS) -> DataFrame:
    """TF-IDF vector of each movie: ``movieId, idx, val, norm``.

    A movie may have one row of content or several: counts are summed per movie and bucket, with
    partial sums before the shuffle. Texts that occur often, as tags do, are taken apart once.
    Document frequencies are at most ``dimensions`` rows.
    """
    pieces = written(content.groupBy("movieId", "content").agg(F.count("*").alias("times")), "pieces")
    texts = _terms(pieces.select(F.col("content").alias("_text")).distinct().withColumn("content", F.col("_text")))
    hashed = HashingTF(inputCol="terms", outputCol="counts", numFeatures=dimensions).transform(texts)
    vector = F.unwrap_udt("counts")
    cells = hashed.select("_text", F.arrays_zip(vector["indices"].alias("idx"), vector["values"].alias("val")).alias("cells"))
    counts = (
        pieces.join(cells, F.col("content").eqNullSafe(F.col("_text")))
        .select("movieId", "times", F.explode_outer("cells").alias("c"))
        .groupBy("movieId", F.col("c.idx").alias("idx"))
        .agg(F.sum(F.col("times") * F.col("c.val")).alias("tf"))
    )
    counts = written(counts, "term-counts")
    movies = counts.select(F.count_distinct("movieId")).scalar()
    idf = F.log((movies + F.lit(1.0)) / (F.col("df") + F.lit(1.0)))
    frequencies = counts.groupBy("idx").agg(F.count("*").alias("df")).select("idx", idf.alias("idf"))
    weighted = counts.join(frequencies, "idx", "left").select(
        "movieId", F.when(F.col("idx").isNotNull(), F.struct("idx", (F.col("tf") * F.col("idf")).alias("val"))).alias("cell")
    )
    # At most one cell per dimension.
    return (
        weighted.groupBy("movieId")
        .agg(F.sort_array(F.collect_list("cell")).alias("cells"))
        .select("movieId", F.col("cells.idx").alias("idx"), F.col("cells.val").alias("val"))
        .withColumn("norm", norm(F.col("val")))
    )


def term_weights(content: DataFrame) -> DataFrame:
    """TF-IDF by term instead of bucket, ``movieId, term, weight``: no hash collisions."""
    terms = (
        _terms(content)
        .select("movieId", F.explode("terms").alias("term"))
        .groupBy("movieId", "term")
        .agg(F.count("*").alias("tf"))
    )
    documents = content.select(F.count_distinct("movieId")).scalar()
    frequencies = terms.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log((documents + F.lit(1.0)) / (F.col("df") + F.lit(1.0)))
    return terms.join(frequencies, "term").select(
        "movieId", "term", (F.col("tf") * idf).alias("weight")
    )


def item_features(vectors: DataFrame, statistics: DataFrame) -> DataFrame:
    """Vectors with mean and count; a default mean and no votes where a movie is unrated."""
    return vectors.join(statistics, "movieId", "left").select(
        "movieId",
        "idx",
        "val",
        "norm",
        F.coalesce("avg_rating", F.lit(DEFAULT_RATING)).alias("avg_rating"),
        F.coalesce("rating_count", F.lit(0)).alias("rating_count"),
    )


def liked_movies(
    ratings: DataFrame, min_rating: float = LIKE_THRESHOLD, per_user: int | None = None
) -> DataFrame:
    """The movies each user likes; with ``per_user`` the best of them: by rating, then time, then movie."""
    likes = ratings.filter(F.col("rating") >= min_rating)
    if per_user is None:
        return likes.select("userId", "movieId", "rating")
    order = [F.desc("rating"), F.desc("ts"), F.asc("movieId")]
    return top_per_key(likes, ["userId"], order, per_user).select("userId", "movieId", "rating")


def user_profiles(likes: DataFrame, vectors: DataFrame) -> DataFrame:
    """Rating-weighted mean vector of the liked items: ``userId, idx, val, norm``.

    Sums per user and index are combined before the shuffle, so a heavy user is no heavier than
    the dimension. Index -1 carries the weight of the user.
    """
    weight = F.struct(F.lit(-1).alias("idx"), F.lit(1.0).alias("val"))
    entries = F.concat(F.array(weight), F.arrays_zip("idx", "val"))
    summed = (
        likes.join(vectors.select("movieId", "idx", "val"), "movieId")
        .select("userId", "rating", "idx", "val")
        .select("userId", "rating", F.explode(entries).alias("e"))
        .groupBy("userId", F.col("e.idx").alias("idx"))
        .agg(F.sum(F.col("rating") * F.col("e.val")).alias("total"))
    )
    grouped = summed.groupBy("userId").agg(
        F.max(F.when(F.col("idx") < 0, F.col("total"))).alias("weight"),
        F.sort_array(
            F.collect_list(F.when(F.col("idx") >= 0, F.struct("idx", "total")))
        ).alias("entries"),
    )
    return (
        grouped.filter(F.col("weight") > 0)
        .select(
            "userId",
            F.col("entries.idx").alias("idx"),
            F.transform("entries", lambda e: e["total"] / F.col("weight")).alias("val"),
        )
        .withColumn("norm", norm(F.col("val")))
    )


def quality_candidates(
    features: DataFrame,
    min_average: float = QUALITY_MIN_AVERAGE,
    min_votes: int = QUALITY_MIN_VOTES,
    limit: int | None = None,
) -> DataFrame:
    """Well rated movies with enough votes; with ``limit`` the most voted of them."""
    fit = features.filter((F.col("avg_rating") >= min_average) & (F.col("rating_count") >= min_votes))
    if limit is None:
        return fit
    return fit.orderBy(F.desc("rating_count"), F.desc("avg_rating"), F.asc("movieId")).limit(limit)


def competitive_candidates(candidates: DataFrame, k: int, seen: DataFrame | None = None) -> DataFrame:
    """The candidates that can be among anyone's ``k`` best; nothing that could be is lost.

    Movies with the same vector are equally similar to everyone, so only their means tell them apart.
    Of equal means the ``k`` lowest ids suffice, and of lower means none that is further below the k-th
    best than rounding can bridge. Where movies that a user has ``seen`` (``userId, movieId``) are left out, as many more
    are kept of a vector as the user who has seen most of its movies.
    """
    slack = 4 * 10.0**-SCORE_DECIMALS / AVERAGE_WEIGHT * MAX_SCORE
    vector = ["idx", "val"]
    if seen is None:
        seen_most, more = None, 0
    else:
        named = candidates.join(candidates.groupBy(*vector).agg(F.min("movieId").alias("_first")), vector).select("movieId", "_first")
        times = seen.select("userId", "movieId").join(named, "movieId").groupBy("userId", "_first").agg(F.count("*").alias("_more"))
        seen_most = written(times.groupBy("_first").agg(F.max("_more").cast("int").alias("_more")), "seen-most")
        more = seen_most.agg(F.max("_more")).first()[0] or 0
    rows = top_per_key(candidates, [*vector, "avg_rating"], [F.asc("movieId")], k + more, "_place").drop("_place")
    best = top_per_key(rows.select(*vector, "avg_rating"), vector, [F.desc("avg_rating")], k + more, "_place")
    if seen_most is not None:
        firsts = candidates.groupBy(*vector).agg(F.min("movieId").alias("_first"))
        allowed = firsts.join(seen_most, "_first", "left").select(*vector, F.coalesce("_more", F.lit(0)).alias("_more"))
        best = best.join(allowed, vector).filter(F.col("_place") <= F.lit(k) + F.col("_more"))
    floor = best.groupBy(*vector).agg(F.min("avg_rating").alias("_floor"))
    return rows.join(floor, vector).filter(F.col("avg_rating") >= F.col("_floor") - F.lit(slack)).drop("_floor")


def content_top_k(
    profiles: DataFrame,
    candidates: DataFrame,
    k: int = LIST_SIZE,
    dimensions: int = TEXT_DIMENSIONS,
    per_pass: int = CANDIDATES_PER_PASS,
    history: DataFrame | None = None,
    skipped=None,
) -> DataFrame:
    """The ``k`` best candidates of every user: ``userId, rank, movieId, score``.

    The score is a weighted sum of similarity to the profile and mean rating. Users stay where
    they are: a pass multiplies blocks of profiles with at most ``per_pass`` candidates that
    every executor holds until the pass is written. The lists of the passes are merged exactly;
    hand in written profiles. Candidates that cannot enter any list are left out beforehand. With a
    ``history`` a user's rated movies are left out; then few candidates are not worth the joins that thin them.
    Users whose profile has no weight get no list.
    """
    users = profiles.filter(F.col("norm") > 0).select("userId", "idx", "val", "norm")
    chosen = candidates
    if history is None:
        chosen = competitive_candidates(candidates, k)
    elif candidates.count() > CANDIDATES_PER_PASS:
        history = written(history.select("userId", "movieId").join(candidates.select("movieId"), "movieId", "left_semi"), "seen")
        chosen = competitive_candidates(candidates, k, history)
    base = F.col("avg_rating") / MAX_SCORE * AVERAGE_WEIGHT
    return top_by_passes(users, chosen.withColumn("base", base), k, dimensions, per_pass, history=history, skipped=skipped)


def content_predictions(test: DataFrame, profiles: DataFrame, vectors: DataFrame) -> DataFrame:
    """Test rows with ``pred_cbf``: similarity on the rating scale, a default where unknown.

    Item vectors are joined first: they are small, so the rows that travel to the user join
    stay small, and the profile is used at once and not carried further.
    """
    items = vectors.select(
        "movieId", F.col("idx").alias("i_idx"), F.col("val").alias("i_val"), F.col("norm").alias("i_norm")
    )
    people = profiles.select(
        "userId", F.col("idx").alias("u_idx"), F.col("val").alias("u_val"), F.col("norm").alias("u_norm")
    )
    lengths = F.col("i_norm") * F.col("u_norm")
    cosine = F.when(
        lengths > 0,
        sparse_dot(F.col("i_idx"), F.col("i_val"), F.col("u_idx"), F.col("u_val")) / lengths,
    )
    return (
        test.join(items, "movieId", "left")
        .join(people, "userId", "left")
        .select(*[F.col(c) for c in test.columns], similarity_rating(cosine).alias("pred_cbf"))
    )
