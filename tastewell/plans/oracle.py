"""SQL twins of the registered queries, for DuckDB on the same tables.

Written independently of the operators: row numbers instead of maxima, terms instead of hashed
buckets, joins instead of array functions.
"""

from __future__ import annotations

LIKES = 10
MIN_AVERAGE = 2.8
MIN_VOTES = 30
LIST_MIN_VOTES = 25

INPUTS = """
lines AS (
  SELECT CAST(o.o_custkey AS BIGINT) AS userId, CAST(l.l_partkey AS BIGINT) AS movieId,
         CAST(CEIL(l.l_quantity / 5.0) AS DOUBLE) / 2 AS rating,
         CAST(epoch(o.o_orderdate) AS BIGINT) AS ts,
         o.o_orderdate, l.l_quantity, l.l_linenumber, l.l_returnflag, o.o_orderpriority
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
ratings_raw AS (SELECT userId, movieId, rating, ts FROM lines),
ratings AS (
  SELECT userId, movieId, rating, ts FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY userId, movieId
                                 ORDER BY o_orderdate DESC, l_quantity DESC) AS rn FROM lines)
  WHERE rn = 1),
movies AS (
  SELECT CAST(p_partkey AS BIGINT) AS movieId, p_name AS title,
         CASE WHEN p_partkey % 50 = 0 THEN '(no genres listed)' WHEN p_partkey % 50 = 1 THEN ''
              ELSE CONCAT(split_part(p_name, ' ', 1), '|', split_part(p_name, ' ', 2), '|', p_type)
         END AS genres
  FROM part),
tags_raw AS (
  SELECT userId, movieId,
         CASE WHEN l_linenumber = 7 THEN ' ' ELSE lower(split_part(o_orderpriority, '-', 2)) END AS tag,
         ts
  FROM lines WHERE l_returnflag = 'R'),
tags AS (SELECT * FROM tags_raw WHERE trim(tag) <> ''),
stats AS (SELECT movieId, AVG(rating) AS avg_rating, COUNT(*) AS rating_count FROM ratings GROUP BY 1),
raw_stats AS (
  SELECT movieId, AVG(rating) AS avg_rating, COUNT(*) AS rating_count FROM ratings_raw GROUP BY 1),
enriched AS (
  SELECT movieId, m.title, m.genres, s.avg_rating, s.rating_count
  FROM movies m FULL JOIN raw_stats s USING (movieId)),
sides AS (
  SELECT *, CAST('0x' || substr(md5(userId || '-' || movieId), 1, 8) AS BIGINT) % 10000 AS side FROM ratings),
train AS (SELECT userId, movieId, rating, ts FROM sides WHERE side < 8000),
test AS (SELECT userId, movieId, rating, ts FROM sides WHERE side >= 8000),
genre_of AS (
  SELECT trim(g) AS genre FROM (
    SELECT unnest(string_split(genres, '|')) AS g FROM movies
    WHERE genres <> '' AND genres <> '(no genres listed)') WHERE trim(g) <> ''),
genre_stats AS (SELECT genre, COUNT(*) AS count FROM genre_of GROUP BY 1),
history AS (
  SELECT r.userId, r.movieId, COALESCE(m.title, 'ID:' || r.movieId) AS title,
         COALESCE(m.genres, 'Unknown') AS genres, r.rating,
         CASE WHEN r.ts > 0 THEN strftime(CAST(make_timestamp(r.ts * 1000000) AS DATE), '%Y-%m-%d') END AS date
  FROM ratings r LEFT JOIN movies m USING (movieId)),
user_genres AS (
  SELECT userId, genre, AVG(rating) AS avg_rating, COUNT(*) AS count
  FROM (SELECT userId, rating, unnest(string_split(genres, '|')) AS genre FROM history) GROUP BY 1, 2)
"""

TEXT = """,
placed_tags AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY movieId ORDER BY ts, userId, tag) AS place FROM tags),
tag_text AS (
  SELECT movieId, string_agg(tag, ' ' ORDER BY place) AS tags_text
  FROM placed_tags WHERE place <= 100 GROUP BY 1),
all_tags AS (SELECT movieId, string_agg(tag, ' ' ORDER BY place) AS tags_text FROM placed_tags GROUP BY 1),
shown_tags AS (
  SELECT movieId, string_agg(tag, ' ' ORDER BY ts, tag) AS tags_text
  FROM (SELECT movieId, tag, MIN(ts) AS ts FROM tags GROUP BY 1, 2) GROUP BY 1),
content AS (
  SELECT movieId, concat_ws(' ', replace(genres, '|', ' '), COALESCE(tags_text, '')) AS content
  FROM movies LEFT JOIN tag_text USING (movieId)),
whole_content AS (
  SELECT movieId, concat_ws(' ', replace(genres, '|', ' '), COALESCE(tags_text, '')) AS content
  FROM movies LEFT JOIN all_tags USING (movieId)),
words AS (
  SELECT movieId, unnest(CASE
      WHEN content = '' THEN ['']
      WHEN rtrim(content, ' ') = '' THEN []
      ELSE string_split(rtrim(lower(content), ' '), ' ') END) AS term
  FROM whole_content),
terms AS (SELECT movieId, term, COUNT(*) AS tf FROM words WHERE term <> 'not' GROUP BY 1, 2),
idf AS (
  SELECT term, ln(((SELECT COUNT(*) FROM content) + 1.0) / (COUNT(*) + 1.0)) AS idf FROM terms GROUP BY 1),
weights AS (SELECT movieId, term, tf * idf AS weight FROM terms JOIN idf USING (term)),
norms AS (
  SELECT movieId, COALESCE(SUM(weight), 0) AS total, sqrt(COALESCE(SUM(weight * weight), 0)) AS norm
  FROM content LEFT JOIN weights USING (movieId) GROUP BY 1),
features AS (
  SELECT movieId, norm, COALESCE(avg_rating, 3.0) AS avg_rating, COALESCE(rating_count, 0) AS rating_count
  FROM norms LEFT JOIN stats USING (movieId)),
"""


def _profiles(source: str, name: str) -> str:
    return f"""
{name}_likes AS (SELECT userId, movieId, rating, ts FROM {source} WHERE rating >= 4.0),
{name}_weight AS (
  SELECT userId, SUM(rating) AS weight FROM {name}_likes JOIN content USING (movieId) GROUP BY 1),
{name}_terms AS (
  SELECT userId, term, SUM(rating * w.weight) / ANY_VALUE(u.weight) AS value
  FROM {name}_likes JOIN weights w USING (movieId) JOIN {name}_weight u USING (userId) GROUP BY 1, 2),
{name} AS (
  SELECT userId, COALESCE(SUM(value), 0) AS total, sqrt(COALESCE(SUM(value * value), 0)) AS norm
  FROM {name}_weight LEFT JOIN {name}_terms USING (userId) GROUP BY 1)"""


CONTENT_PREDICTIONS = """,
dots AS (
  SELECT t.userId, t.movieId, SUM(w.weight * p.value) AS dot
  FROM test t JOIN weights w ON w.movieId = t.movieId
  JOIN fitted_terms p ON p.userId = t.userId AND p.term = w.term GROUP BY 1, 2),
content_predictions AS (
  SELECT t.userId, t.movieId, t.rating, t.ts,
         CASE WHEN n.norm > 0 AND f.norm > 0 THEN 1.0 + 4.0 * COALESCE(d.dot, 0) / (n.norm * f.norm)
              ELSE 3.0 END AS pred_cbf
  FROM test t LEFT JOIN norms n ON n.movieId = t.movieId LEFT JOIN fitted f ON f.userId = t.userId
  LEFT JOIN dots d ON d.userId = t.userId AND d.movieId = t.movieId)"""

LISTS = f""",
als AS (
  SELECT * FROM (
    SELECT userId, movieId, avg_rating AS score,
           CAST(ROW_NUMBER() OVER (PARTITION BY userId ORDER BY avg_rating DESC, movieId) AS INT) AS rank
    FROM ratings JOIN stats USING (movieId)) WHERE rank <= 20),
cbf AS (
  SELECT * FROM (
    SELECT userId, movieId, avg_rating / 5.0 AS score,
           CAST(ROW_NUMBER() OVER (PARTITION BY userId ORDER BY avg_rating / 5.0 DESC, movieId) AS INT) AS rank
    FROM (SELECT DISTINCT userId, movieId FROM tags) JOIN stats USING (movieId)) WHERE rank <= 10),
blend AS (
  SELECT userId, movieId,
         CASE WHEN a.score IS NOT NULL AND c.score IS NOT NULL THEN a.score * 0.7 + c.score * 0.3
              WHEN a.score IS NOT NULL THEN a.score ELSE c.score END AS score
  FROM als a FULL JOIN cbf c USING (userId, movieId)),
hybrid AS (
  SELECT * FROM (
    SELECT userId, movieId, score,
           CAST(ROW_NUMBER() OVER (PARTITION BY userId ORDER BY score DESC, movieId) AS INT) AS rank
    FROM blend b
    WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.userId = b.userId AND t.movieId = b.movieId)
      AND movieId IN (SELECT movieId FROM train GROUP BY 1 HAVING COUNT(*) >= {LIST_MIN_VOTES}))
  WHERE rank <= 10),
shown AS (
  SELECT h.userId, h.rank, h.movieId, COALESCE(e.title, 'Unknown') AS title,
         COALESCE(e.genres, 'Unknown') AS genres, COALESCE(e.avg_rating, 0.0) AS avg_rating,
         CAST(printf('%.2f', greatest(0.0, least(5.0, h.score))) AS DOUBLE) AS pred_rating
  FROM hybrid h JOIN enriched e USING (movieId)),
listing AS (
  SELECT userId, COUNT(*) AS total,
         string_agg(title || ' (' || printf('%.1f', pred_rating) || '★)', ' | ' ORDER BY rank)
           AS details
  FROM shown GROUP BY 1)
"""

# Five loads: each fifth of the movies comes with its own, and one later load may rate a key again.
RATED_AGAIN = """,
rated_again AS (
  SELECT userId, movieId, CASE WHEN userId % 7 > movieId % 5 AND userId % 7 < 5 THEN 5.5 - rating ELSE rating END AS rating
  FROM ratings)"""

RUNS = """,
movie_mean AS (SELECT movieId, AVG(rating) AS pred_als FROM train GROUP BY 1),
user_mean AS (SELECT userId, AVG(rating) AS pred_cbf FROM train GROUP BY 1),
predicted AS (
  SELECT strftime(make_timestamp(ts * 1000000), '%Y') AS run_id, rating, pred_als, pred_cbf,
         CASE WHEN pred_als IS NOT NULL AND pred_cbf IS NOT NULL THEN pred_als * 0.7 + pred_cbf * 0.3
              ELSE COALESCE(pred_als, pred_cbf, 3.0) END AS pred_hybrid
  FROM test LEFT JOIN movie_mean USING (movieId) LEFT JOIN user_mean USING (userId)),
long_form AS (
  SELECT run_id, 'als' AS model, rating, pred_als AS p FROM predicted
  UNION ALL SELECT run_id, 'cbf', rating, pred_cbf FROM predicted
  UNION ALL SELECT run_id, 'hybrid', rating, pred_hybrid FROM predicted),
runs AS (
  SELECT run_id, model, sqrt(AVG((rating - p) * (rating - p))) AS rmse, AVG(abs(rating - p)) AS mae
  FROM long_form GROUP BY 1, 2),
best AS (
  SELECT run_id, model AS winner_model, rmse, mae FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY run_id ORDER BY rmse, model) AS rn FROM runs) WHERE rn = 1),
changes AS (
  SELECT run_id, winner_model, rmse, rmse - LAG(rmse) OVER (ORDER BY run_id) AS rmse_change FROM best),
newest AS (SELECT * FROM changes ORDER BY run_id DESC LIMIT 1),
newest_models AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY model ORDER BY run_id DESC) AS rn FROM runs)
  WHERE rn = 1),
overview AS (
  SELECT COUNT(DISTINCT userId) AS user_count, (SELECT COUNT(*) FROM movies) AS movie_count,
         COUNT(*) AS rating_count FROM ratings_raw)
"""


def _sql(select: str, *parts: str) -> str:
    return f"WITH {INPUTS}{''.join(parts)} {select}"


def _text(select: str, extra: str = "") -> str:
    body = TEXT.rstrip().rstrip(",")
    return _sql(select, body, extra)


def _errors(source: str, prediction: str, by: str = "") -> str:
    head, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return (
        f"SELECT {head}round(sqrt(AVG((rating - {prediction}) * (rating - {prediction}))), 6) AS rmse, "
        f"round(AVG(abs(rating - {prediction})), 6) AS mae, COUNT({prediction}) AS scored, "
        f"round(CAST(COUNT({prediction}) AS DOUBLE) / COUNT(*), 6) AS coverage FROM {source}{tail}"
    )


BINS = ", ".join(f"({b / 2.0})" for b in range(1, 11))
HISTOGRAM = f"""SELECT CAST(b.rating AS DOUBLE) AS rating, COUNT(r.rating) AS count
FROM (VALUES {BINS}) AS b(rating) LEFT JOIN ratings_raw r ON r.rating = b.rating GROUP BY 1"""
WIDE_BINS = ", ".join(
    f"COUNT(*) FILTER (WHERE rating = {b / 2.0}) AS r_{str(b / 2.0).replace('.', '_')}" for b in range(1, 11)
)
SERIALISED = """SELECT userId, string_agg(movieId || ':' || printf('%.2f',
  greatest(0.0, least(5.0, score))), ',' ORDER BY rank) AS items FROM als GROUP BY 1"""
CBF_TOP = f"""
, chosen AS (
  SELECT * FROM features WHERE avg_rating >= {MIN_AVERAGE} AND rating_count >= {MIN_VOTES}),
pair_dots AS (
  SELECT p.userId, w.movieId, SUM(p.value * w.weight) AS dot
  FROM fitted_terms p JOIN (SELECT w.* FROM weights w JOIN chosen USING (movieId)) w USING (term)
  GROUP BY 1, 2),
scored AS (
  SELECT u.userId, c.movieId,
         round(0.6 * CASE WHEN c.norm > 0 THEN COALESCE(d.dot, 0) / (c.norm * u.norm) ELSE 0 END
               + c.avg_rating / 5.0 * 0.4, 9) AS score
  FROM fitted u CROSS JOIN chosen c
  LEFT JOIN pair_dots d ON d.userId = u.userId AND d.movieId = c.movieId WHERE u.norm > 0)
"""


def statements() -> dict[str, str]:
    profile = "," + _profiles("ratings", "fitted")
    fitted = "," + _profiles("train", "fitted")
    return {
        "ratings_latest": _sql("SELECT * FROM ratings"),
        "tags_clean": _sql("SELECT * FROM tags"),
        "ingest_movies": "SELECT CAST(p_partkey AS BIGINT) AS movieId, p_name || ', \"' || p_brand || '\"' "
        "|| chr(10) || p_type AS title, p_type AS genres FROM part",
        "ingest_movies_split": "SELECT CAST(p_partkey AS BIGINT) AS movieId, "
        "CASE WHEN p_partkey % 7 = 1 THEN p_name ELSE p_name || ', \"' || p_brand || '\"' END AS title, "
        "p_type AS genres FROM part WHERE p_partkey % 7 NOT IN (0, 2)",
        "ingest_overview": "SELECT CASE p_partkey % 7 WHEN 0 THEN 'too few fields' WHEN 2 THEN 'unbalanced quote' "
        "ELSE 'accepted' END AS reason, COUNT(*) AS rows FROM part GROUP BY 1",
        "movie_line_count": _sql("SELECT CAST(movieId AS VARCHAR) AS movie, COUNT(*) AS lines FROM lines GROUP BY 1"),
        "ingest_ratings": _sql(
            "SELECT userId, movieId, rating, ts FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY userId, "
            "movieId ORDER BY ts DESC, rating DESC) AS rn FROM lines WHERE l_linenumber <> 7) WHERE rn = 1"
        ),
        "ingest_tags": _sql("SELECT * FROM tags"),
        "ingest_rejects": _sql(
            "SELECT 'ratings' AS source, 'rating is not a number' AS reason, COUNT(*) AS rows FROM lines "
            "WHERE l_linenumber = 7 UNION ALL SELECT 'tags', 'blank tag', COUNT(*) FROM tags_raw "
            "WHERE trim(tag) = ''"
        ),
        "wide_ratings": _sql("SELECT * FROM ratings"),
        "stored_movies": _sql("SELECT * FROM movies"),
        "tag_layouts": _sql(
            "SELECT userId, movieId, tag, CASE WHEN tag IN ('urgent', 'low') THEN ts ELSE 0 END AS ts FROM tags"
        ),
        "result_files_merged": _sql(
            "SELECT movieId, title, genres, CAST(printf('%.2f', avg_rating) AS DOUBLE) AS avg_rating, rating_count FROM enriched"
        ),
        "genre_result_files": _sql("SELECT * FROM genre_stats"),
        "stored_statistics": _sql(
            "SELECT 'movies' AS table_name, COUNT(*) AS rows, CAST(SUM(rating_count) AS BIGINT) AS total "
            "FROM enriched UNION ALL SELECT 'genre_stats', COUNT(*), CAST(SUM(count) AS BIGINT) FROM genre_stats "
            "UNION ALL SELECT 'rating_stats', COUNT(DISTINCT rating), COUNT(*) FROM ratings_raw "
            "UNION ALL SELECT 'system_stats', 1, COUNT(*) FROM ratings_raw"
        ),
        "stored_recommendations": _sql(
            "SELECT 'hybrid' AS model, userId, rank, movieId, score FROM hybrid", LISTS
        ),
        "movie_rating_count": _sql("SELECT movieId, rating_count FROM raw_stats"),
        "movie_avg_rating": _sql(
            "SELECT movieId, avg_rating, CAST(printf('%.2f', avg_rating) AS DOUBLE) AS avg_shown FROM raw_stats"
        ),
        "genre_count": _sql("SELECT * FROM genre_stats"),
        "genre_summary": _sql(
            "SELECT CAST(SUM(count) AS BIGINT) AS assignments, "
            "(SELECT genre FROM genre_stats ORDER BY count DESC, genre LIMIT 1) AS top_genre, "
            "MAX(count) AS top_count, AVG(count) AS avg_per_genre FROM genre_stats"
        ),
        "genre_chart": _sql(
            "SELECT genre, count, CASE WHEN count > SUM(count) OVER () * 0.03 THEN CAST(count AS VARCHAR) "
            "ELSE '' END AS label, ROW_NUMBER() OVER (ORDER BY count DESC, genre) AS ordinal FROM genre_stats"
        ),
        "rating_distribution": _sql("SELECT rating, COUNT(*) AS count FROM ratings_raw GROUP BY 1"),
        "rating_bins": _sql(HISTOGRAM),
        "rating_bins_wide": _sql(f"SELECT {WIDE_BINS} FROM ratings_raw"),
        "system_overview": _sql("SELECT * FROM overview", RUNS),
        "movie_enriched": _sql("SELECT * FROM enriched"),
        "movie_details": _text(
            "SELECT movieId, COALESCE(title, 'Unknown') AS title, COALESCE(genres, '--') AS genres, "
            "COALESCE(avg_rating, 0.0) AS avg_rating, COALESCE(rating_count, 0) AS rating_count, "
            "COALESCE(tags_text, '') AS tags FROM enriched LEFT JOIN shown_tags USING (movieId)"
        ),
        "top_movies": _sql(
            "SELECT movieId, COALESCE(title, 'Unknown') AS title, rating_count FROM enriched "
            "WHERE rating_count > 0 ORDER BY rating_count DESC, movieId LIMIT 10"
        ),
        "user_history": _sql("SELECT * FROM history"),
        "user_history_numbered": _sql(
            "SELECT userId, ROW_NUMBER() OVER (PARTITION BY userId ORDER BY date DESC NULLS LAST, rating DESC, "
            "movieId) AS ordinal, movieId, title, rating, date FROM history"
        ),
        "user_history_summary": _sql(
            "SELECT userId, COUNT(*) AS rated, AVG(rating) AS avg_rating FROM ratings GROUP BY 1"
        ),
        "user_genre_profile": _sql("SELECT * FROM user_genres"),
        "user_top_genre": _sql(
            "SELECT userId, genre, count FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY userId "
            "ORDER BY count DESC, genre) AS rn FROM user_genres) WHERE rn = 1"
        ),
        "user_ratings_map": _sql("SELECT userId, movieId, rating FROM ratings"),
        "movie_tags_text": _text(
            "SELECT movieId, string_agg(tag, ' ' ORDER BY place) AS tags_text FROM placed_tags "
            "WHERE place <= 100 GROUP BY 1"
        ),
        "movie_content": _text("SELECT * FROM content"),
        "tfidf_terms": _text("SELECT movieId, term, round(weight, 6) AS weight FROM weights"),
        "tfidf_hashed": _text(
            "SELECT movieId, round(total, 6) AS total, round(norm, 6) AS norm FROM norms"
        ),
        "liked_movies": _text(
            "SELECT userId, movieId, rating FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY userId "
            f"ORDER BY rating DESC, ts DESC, movieId) AS rn FROM fitted_likes) WHERE rn <= {LIKES}",
            profile,
        ),
        "user_profile": _text(
            "SELECT userId, round(total, 6) AS total, round(norm, 6) AS norm FROM fitted", profile
        ),
        "item_features": _text(
            "SELECT movieId, round(norm, 6) AS norm, avg_rating, rating_count FROM features"
        ),
        "quality_candidates": _text(
            f"SELECT movieId, avg_rating, rating_count FROM features WHERE avg_rating >= {MIN_AVERAGE} "
            f"AND rating_count >= {MIN_VOTES}"
        ),
        "quality_limit": _text(
            f"SELECT movieId, avg_rating, rating_count FROM features WHERE avg_rating >= {MIN_AVERAGE} "
            f"AND rating_count >= {MIN_VOTES} ORDER BY rating_count DESC, avg_rating DESC, movieId LIMIT 40"
        ),
        "cbf_topk": _text(
            "SELECT userId, rank, movieId, score FROM (SELECT *, CAST(ROW_NUMBER() OVER "
            "(PARTITION BY userId ORDER BY score DESC, movieId) AS INT) AS rank FROM scored) WHERE rank <= 10",
            profile + CBF_TOP,
        ),
        "cbf_predictions": _text(
            "SELECT userId, movieId, rating, ts, round(pred_cbf, 6) AS pred_cbf FROM content_predictions",
            fitted + CONTENT_PREDICTIONS,
        ),
        "cbf_eval": _text(_errors("content_predictions", "pred_cbf"), fitted + CONTENT_PREDICTIONS),
        "split_counts": _sql(
            "SELECT 'train' AS side, COUNT(*) AS rows, SUM(rating) AS total FROM train "
            "UNION ALL SELECT 'test', COUNT(*), SUM(rating) FROM test"
        ),
        "split_by_user": _sql(
            "SELECT userId, COUNT(*) AS rows, CAST(SUM(movieId) AS BIGINT) AS movies FROM test GROUP BY 1"
        ),
        "ratings_latest_nulls": _sql(
            "SELECT userId, movieId, CASE WHEN movieId % 10 <> 3 THEN rating END AS rating, "
            "CASE WHEN movieId % 10 <> 4 THEN ts ELSE 0 END AS ts FROM ratings"
        ),
        "user_history_numbered_nulls": _sql(
            "SELECT userId, ROW_NUMBER() OVER (PARTITION BY userId ORDER BY date DESC NULLS LAST, rating DESC NULLS LAST, "
            "movieId) AS ordinal, movieId, rating, date FROM (SELECT userId, movieId, "
            "CASE WHEN movieId % 10 <> 3 THEN rating END AS rating, CASE WHEN movieId % 10 <> 4 THEN date END AS date "
            "FROM history)"
        ),
        "recs_flat": _sql("SELECT userId, rank, movieId, score FROM als", LISTS),
        "recs_serialized": _sql(SERIALISED, LISTS),
        "recs_parsed": _sql(
            "SELECT userId, rank, movieId, CAST(printf('%.2f', greatest(0.0, least(5.0, score))) AS DOUBLE) AS score FROM als",
            LISTS,
        ),
        "recs_movies": _sql("SELECT DISTINCT movieId FROM als", LISTS),
        "scores_clamped": _sql(
            "SELECT greatest(0.0, least(5.0, rating * 2 - 3)) AS score, COUNT(*) AS rows FROM ratings_raw GROUP BY 1"
        ),
        "history_filter": _sql(
            "SELECT userId, rank, movieId, score FROM als a WHERE NOT EXISTS "
            "(SELECT 1 FROM train t WHERE t.userId = a.userId AND t.movieId = a.movieId)",
            LISTS,
        ),
        "min_votes_filter": _sql(
            "SELECT userId, rank, movieId, score FROM als WHERE movieId IN "
            f"(SELECT movieId FROM ratings GROUP BY 1 HAVING COUNT(*) >= {LIST_MIN_VOTES})",
            LISTS,
        ),
        "hybrid_blend": _sql("SELECT userId, movieId, score FROM blend", LISTS),
        "hybrid_blend_rating_scale": _sql(
            "SELECT userId, movieId, CASE WHEN a.score IS NOT NULL AND c.score IS NOT NULL "
            "THEN a.score * 0.7 + c.score * 5.0 * 0.3 WHEN a.score IS NOT NULL THEN a.score "
            "ELSE c.score * 5.0 END AS score FROM als a FULL JOIN cbf c USING (userId, movieId)",
            LISTS,
        ),
        "hybrid_lists": _sql("SELECT userId, rank, movieId, score FROM hybrid", LISTS),
        "hybrid_eval": _text(
            _errors("long_predictions", "p", "model"),
            fitted
            + CONTENT_PREDICTIONS
            + """,
means AS (SELECT movieId, AVG(rating) AS pred_als FROM train GROUP BY 1),
three AS (
  SELECT rating, pred_als, pred_cbf,
         CASE WHEN pred_als IS NOT NULL THEN pred_als * 0.7 + pred_cbf * 0.3 ELSE pred_cbf END AS pred_hybrid
  FROM content_predictions LEFT JOIN means USING (movieId)),
long_predictions AS (
  SELECT 'als' AS model, rating, pred_als AS p FROM three
  UNION ALL SELECT 'cbf', rating, pred_cbf FROM three
  UNION ALL SELECT 'hybrid', rating, pred_hybrid FROM three)""",
        ),
        "recs_for_user": _sql("SELECT * FROM shown", LISTS),
        "recs_for_user_by_model": _sql(
            "SELECT a.userId, a.rank, a.movieId, COALESCE(e.title, 'Unknown') AS title, "
            "COALESCE(e.genres, 'Unknown') AS genres, COALESCE(e.avg_rating, 0.0) AS avg_rating, "
            "CAST(printf('%.2f', greatest(0.0, least(5.0, a.score))) AS DOUBLE) AS pred_rating "
            "FROM als a JOIN enriched e USING (movieId) WHERE a.rank <= 10",
            LISTS,
        ),
        "community_vs_predicted": _sql(
            "SELECT userId, movieId, title, avg_rating, pred_rating, "
            "pred_rating - avg_rating AS difference FROM shown",
            LISTS,
        ),
        "recs_listing": _sql("SELECT * FROM listing ORDER BY CAST(userId AS VARCHAR) LIMIT 100", LISTS),
        "recs_search": _sql(
            "SELECT * FROM listing WHERE regexp_matches(CAST(userId AS VARCHAR), 'RED (bolt|ring)', 'i') "
            "OR regexp_matches(details, 'RED (bolt|ring)', 'i')",
            LISTS,
        ),
        "recs_search_indexed": _sql(
            "SELECT * FROM listing WHERE regexp_matches(CAST(userId AS VARCHAR), 'RED (bolt|ring)', 'i') "
            "OR regexp_matches(details, 'RED (bolt|ring)', 'i')",
            LISTS,
        ),
        "model_metrics": _sql(
            "SELECT run_id, model, round(r.rmse, 6) AS rmse, round(r.mae, 6) AS mae, "
            "r.model = b.winner_model AS is_winner FROM runs r JOIN best b USING (run_id)",
            RUNS,
        ),
        "metrics_from_cells": _sql(
            "SELECT run_id || '-' || model AS model, round(rmse, 6) AS rmse, round(mae, 6) AS mae, "
            "'--' AS updated_at FROM runs",
            RUNS,
        ),
        "winner": _sql(
            "SELECT run_id, winner_model, round(rmse, 6) AS rmse, round(mae, 6) AS mae FROM best", RUNS
        ),
        "rmse_delta": _sql(
            "SELECT run_id, winner_model, round(rmse, 6) AS rmse, round(rmse_change, 6) AS rmse_change "
            "FROM changes",
            RUNS,
        ),
        "latest_run": _sql(
            "SELECT upper(winner_model) AS winner_model, printf('%.4f', rmse) AS rmse, "
            "printf('%+.4f', rmse_change) AS rmse_delta FROM newest",
            RUNS,
        ),
        "model_comparison": _sql(
            "SELECT model, round(rmse, 6) AS rmse, round(mae, 6) AS mae FROM newest_models", RUNS
        ),
        "comparison_with_summary": _sql(
            "SELECT model, round(rmse, 6) AS rmse, round(mae, 6) AS mae FROM newest_models", RUNS
        ),
        "entered_ids": """
            SELECT TRY_CAST(entered AS BIGINT) AS userId FROM (
              SELECT CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderkey AS VARCHAR) WHEN 1 THEN '-' || o_custkey
                     ELSE o_orderkey || '99999999999999999999' END AS entered FROM orders)
            WHERE regexp_full_match(entered, '[0-9]+') AND TRY_CAST(entered AS BIGINT) IS NOT NULL""",
        "wide_ids": _sql("SELECT userId + 3000000000 AS userId, movieId + 3000000000 AS movieId, rating, ts FROM ratings"),
        "loaded_twice": _sql(
            "SELECT userId, movieId, CASE WHEN userId % 4 = 0 THEN 5.5 - rating ELSE rating END AS rating, "
            "CASE WHEN movieId % 3 = 0 OR userId % 4 = 0 THEN ts + 1 ELSE ts END AS ts FROM ratings"
        ),
        "statistics_after_deltas": _sql(
            "SELECT movieId, AVG(rating) AS avg_rating, COUNT(*) AS rating_count FROM rated_again GROUP BY 1", RATED_AGAIN
        ),
        "overview_after_deltas": _sql(
            "SELECT COUNT(DISTINCT userId) AS user_count, COUNT(*) AS rating_count, "
            "(SELECT rating FROM rated_again GROUP BY 1 ORDER BY COUNT(*) DESC, rating DESC LIMIT 1) AS top_rating FROM rated_again",
            RATED_AGAIN,
        ),
        "evaluation_share": _sql(
            "SELECT COUNT(*) FILTER (WHERE rating IS NULL) AS foreign_rows, COUNT(*) - COUNT(DISTINCT (userId, movieId)) AS repeated, "
            "CAST(0 AS BIGINT) AS other_when_drawn_again, COUNT(*) > 0 AS about_a_tenth FROM test"
        ),
        "als_list_shape": _sql(
            "SELECT COUNT(DISTINCT userId) AS users, CAST(COUNT(DISTINCT userId) * LEAST(10, COUNT(DISTINCT movieId)) AS BIGINT) AS items, "
            "CAST(0 AS BIGINT) AS wrong_ranks, CAST(0 AS BIGINT) AS rising_scores, CAST(0 AS BIGINT) AS repeated_movies, "
            "CAST(0 AS BIGINT) AS unknown_movies FROM train"
        ),
        "als_rmse_bound": _sql(
            "SELECT COUNT(*) AS scored, TRUE AS bounded FROM test WHERE userId IN (SELECT userId FROM train) "
            "AND movieId IN (SELECT movieId FROM train)"
        ),
        "hybrid_invariants": _sql(
            "SELECT COUNT(*) AS users, CAST(0 AS BIGINT) AS wrong_ranks, CAST(0 AS BIGINT) AS rising_scores, "
            "CAST(0 AS BIGINT) AS repeated_movies, CAST(0 AS BIGINT) AS rated, CAST(0 AS BIGINT) AS few_votes "
            "FROM (SELECT userId, COUNT(*) FILTER (WHERE votes >= 10) AS seen FROM train JOIN votes USING (movieId) GROUP BY 1) "
            "WHERE seen < (SELECT COUNT(*) FROM votes WHERE votes >= 10)",
            ", votes AS (SELECT movieId, COUNT(*) AS votes FROM train GROUP BY 1)",
        ),
        "training_run_cbf": _text(
            "SELECT 'only' AS run_id, 'cbf' AS model, rmse, mae, TRUE AS is_winner FROM ("
            + _errors("content_predictions", "pred_cbf")
            + ")",
            fitted + CONTENT_PREDICTIONS,
        ),
        "overview_report": _sql(
            "SELECT format('{:,}', user_count) AS user_count, format('{:,}', movie_count) AS movie_count, "
            "format('{:,}', rating_count) AS rating_count, "
            "(SELECT printf('%.4f', rmse) FROM newest) AS rmse_score, "
            "(SELECT printf('%+.4f', rmse_change) FROM newest) AS rmse_delta FROM overview",
            RUNS,
        ),
        "report_rows": _sql(
            "SELECT 'scale' AS section, 'ratings' AS label, format('{:,}', rating_count) AS value FROM overview "
            "UNION ALL SELECT 'scale', 'movies', format('{:,}', movie_count) FROM overview "
            "UNION ALL SELECT 'scale', 'users', format('{:,}', user_count) FROM overview "
            "UNION ALL SELECT 'models', upper(model), 'RMSE = ' || printf('%.4f', rmse) "
            "|| ' | MAE = ' || printf('%.4f', mae) FROM newest_models "
            "UNION ALL SELECT 'genres', genre, CAST(count AS VARCHAR) FROM "
            "(SELECT * FROM genre_stats ORDER BY count DESC, genre LIMIT 3)",
            RUNS,
        ),
    }
