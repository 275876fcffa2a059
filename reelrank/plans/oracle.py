"""DuckDB SQL twins of the views and queries, used as the correctness oracle.

Each query is written independently in plain SQL over the driver's raw tables
(pre-registered as views by the checker). View definitions are shared CTEs.
"""

from __future__ import annotations

from reelrank.schemas import LOG_PAYLOAD_MARKER

VIEWS: dict[str, str] = {
    "v_ratings": """
        SELECT CAST(o.o_custkey AS INTEGER) AS uid,
               CAST(l.l_partkey AS INTEGER) AS mid,
               CAST(ceil(l.l_quantity / 5) AS DOUBLE) / 2 AS score,
               CAST(epoch_us(o.o_orderdate) // 1000000 AS INTEGER) AS "timestamp"
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "v_movies": """
        SELECT CAST(p_partkey AS INTEGER) AS mid, p_name AS name,
               'A ' || p_name || ' movie' AS descri,
               CAST(p_size AS VARCHAR) || ' minutes' AS timelong,
               'June 1, 1998' AS issue, '1998' AS shoot, p_brand AS language,
               concat_ws('|', p_type, replace(p_name, ' ', '|')) AS genres,
               'Cast of ' || p_brand AS actors, '' AS directors
        FROM part""",
    "v_tags": """
        SELECT CAST(user_id AS INTEGER) AS uid,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
               event_type AS tag,
               CAST(epoch_us(ts) // 1000000 AS INTEGER) AS "timestamp"
        FROM events""",
    "v_events": """
        SELECT event_id,
               CAST(user_id AS INTEGER) AS uid,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
               CAST((event_id % 10) + 1 AS DOUBLE) / 2 AS score,
               CAST(epoch_us(ts) // 1000000 AS INTEGER) AS "timestamp"
        FROM events""",
    "v_features": """
        SELECT CAST(vec_id AS INTEGER) AS mid, CAST(embedding AS DOUBLE[]) AS features
        FROM embeddings""",
    "v_genres": """
        SELECT * FROM (VALUES ('Economy'), ('Small'), ('Promo'), ('Ring'),
                              ('Red'), ('Old'), ('Tv')) AS g(genre)""",
}

# dependencies between views (a view listed after the ones it reads)
VIEW_DEPS: dict[str, list[str]] = {}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs it names (in the order given)."""
    ordered: list[str] = []
    for n in names:
        for dep in VIEW_DEPS.get(n, []):
            if dep not in ordered:
                ordered.append(dep)
        if n not in ordered:
            ordered.append(n)
    # materialised: several views read the all-pairs cosine, which must run once
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in ordered)
    return f"WITH {ctes}\n{sql}"


SQL: dict[str, str] = {}

# ---- statistics -------------------------------------------------------------

SQL["rate_more_movies"] = with_views(
    "SELECT mid, count(mid) AS count FROM v_ratings GROUP BY mid", "v_ratings")

SQL["ratings_with_month"] = with_views(
    """SELECT mid, score,
              CAST(strftime(make_timestamp(CAST("timestamp" AS BIGINT) * 1000000), '%Y%m')
                   AS INTEGER) AS yeahmouth
       FROM v_ratings""", "v_ratings")

_MONTH_COUNTS = """
    SELECT mid, count(mid) AS count, yeahmouth FROM (
      SELECT mid, CAST(strftime(make_timestamp(CAST("timestamp" AS BIGINT) * 1000000), '%Y%m')
                       AS INTEGER) AS yeahmouth
      FROM v_ratings) GROUP BY yeahmouth, mid"""
SQL["rate_more_recently"] = with_views(_MONTH_COUNTS, "v_ratings")
SQL["sql_month_counts"] = with_views(_MONTH_COUNTS, "v_ratings")

SQL["average_score"] = with_views(
    "SELECT mid, round(avg(score), 6) AS avg FROM v_ratings GROUP BY mid", "v_ratings")

SQL["distinct_users"] = with_views("SELECT DISTINCT uid FROM v_ratings", "v_ratings")

SQL["movies_with_score"] = with_views(
    """SELECT m.*, round(a.avg, 6) AS avg FROM v_movies m
       JOIN (SELECT mid, avg(score) AS avg FROM v_ratings GROUP BY mid) a USING (mid)""",
    "v_movies", "v_ratings")

SQL["genre_match"] = with_views(
    """SELECT g.genre, m.mid FROM v_movies m JOIN v_genres g
       ON contains(lower(m.genres), lower(g.genre))""", "v_movies", "v_genres")

SQL["genre_table_match"] = with_views(
    """SELECT n.genre, m.mid FROM v_movies m JOIN (
         SELECT unnest(string_split(p_type, ' ')) AS genre FROM part
         UNION SELECT unnest(string_split(p_name, ' ')) FROM part
         UNION SELECT p_type FROM part UNION SELECT c_name FROM customer) n
       ON contains(lower(m.genres), lower(n.genre))""", "v_movies")

SQL["genre_top10"] = with_views(
    """SELECT genre, rank, mid, round(avg, 6) AS avg FROM (
         SELECT g.genre, m.mid, a.avg,
                CAST(row_number() OVER (PARTITION BY g.genre ORDER BY a.avg DESC, m.mid ASC)
                     AS INTEGER) AS rank
         FROM v_movies m
         JOIN (SELECT mid, avg(score) AS avg FROM v_ratings GROUP BY mid) a USING (mid)
         JOIN v_genres g ON contains(lower(m.genres), lower(g.genre)))
       WHERE rank <= 10""", "v_movies", "v_ratings", "v_genres")

SQL["tags_per_movie"] = with_views(
    """SELECT mid, array_to_string(list_sort(list(DISTINCT tag)), '|') AS tags
       FROM v_tags GROUP BY mid""", "v_tags")

SQL["movies_with_tags"] = with_views(
    """SELECT m.*, t.tags FROM v_movies m LEFT JOIN (
         SELECT mid, array_to_string(list_sort(list(DISTINCT tag)), '|') AS tags
         FROM v_tags GROUP BY mid) t USING (mid)""", "v_movies", "v_tags")

# ---- load / write -----------------------------------------------------------

SQL["load_movies"] = with_views("SELECT * FROM v_movies", "v_movies")
SQL["load_ratings"] = with_views("SELECT * FROM v_ratings", "v_ratings")
SQL["load_tags"] = with_views("SELECT * FROM v_tags", "v_tags")
SQL["scan_ratings"] = with_views("SELECT uid, mid, score FROM v_ratings", "v_ratings")
SQL["write_read_roundtrip"] = SQL["movies_with_tags"]

SQL["keyed_dedupe_movies"] = """
    SELECT mid, name FROM (
      SELECT CAST(l.l_partkey AS INTEGER) AS mid,
             p.p_name || ' #' || CAST(l.l_suppkey AS VARCHAR) AS name,
             row_number() OVER (PARTITION BY l.l_partkey
                                ORDER BY l.l_shipdate DESC, l.l_orderkey DESC,
                                         l.l_linenumber DESC) AS rn
      FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
    WHERE rn = 1"""

VIEWS["v_recent_ratings"] = """
    SELECT uid, pos, mid, score, "timestamp" FROM (
      SELECT uid, mid, score, "timestamp",
             CAST(row_number() OVER (PARTITION BY uid
                  ORDER BY "timestamp" DESC, mid DESC, score DESC) AS INTEGER) AS pos
      FROM v_ratings) WHERE pos <= 20"""
VIEW_DEPS["v_recent_ratings"] = ["v_ratings"]

SQL["encode_recs"] = with_views(
    """SELECT uid, string_agg(CAST(mid AS VARCHAR) || ':' || CAST(score AS VARCHAR), '|'
                              ORDER BY pos) AS recs
       FROM v_recent_ratings GROUP BY uid""", "v_recent_ratings")

SQL["decode_recs"] = with_views(
    "SELECT uid, pos, mid, score FROM v_recent_ratings", "v_recent_ratings")

SQL["recs_to_map"] = with_views(
    """SELECT uid, mid, arg_max(score, pos) AS score FROM v_recent_ratings
       GROUP BY uid, mid""", "v_recent_ratings")

# ---- similarity -------------------------------------------------------------


def _sim_view(threshold: float) -> str:
    return f"""
        SELECT a.mid, b.mid AS rid, list_cosine_similarity(a.features, b.features) AS r
        FROM v_features a JOIN v_features b ON a.mid <> b.mid
        WHERE list_dot_product(a.features, a.features) > 0
          AND list_dot_product(b.features, b.features) > 0
          AND list_cosine_similarity(a.features, b.features) > {threshold}"""


VIEWS["v_sim30"] = _sim_view(0.3)
VIEW_DEPS["v_sim30"] = ["v_features"]
VIEWS["v_sim20"] = _sim_view(0.2)
VIEW_DEPS["v_sim20"] = ["v_features"]

SQL["item_similarity"] = with_views("SELECT mid, rid, round(r, 6) AS r FROM v_sim30", "v_sim30")
SQL["recs_explode"] = SQL["item_similarity"]
SQL["recs_segments"] = with_views(
    """SELECT mid, CAST(k AS INTEGER) AS segment, CAST(count(*) AS INTEGER) AS n,
              round(max(r), 6) AS first, round(min(r), 6) AS last
       FROM (SELECT mid, r, (row_number() OVER (PARTITION BY mid ORDER BY r DESC, rid) - 1) // 5 AS k FROM v_sim30)
       GROUP BY mid, k""", "v_sim30")
SQL["cosine_pairs"] = with_views(
    "SELECT mid, rid, round(r, 6) AS cos FROM v_sim30", "v_sim30")

# ---- scoring with factor tables --------------------------------------------

VIEWS["v_profiles"] = """
    SELECT uid, list(x ORDER BY pos) AS features FROM (
      SELECT uid, pos, avg(x) AS x FROM (
        SELECT r.uid, generate_subscripts(f.features, 1) AS pos, unnest(f.features) AS x
        FROM v_ratings r JOIN v_features f USING (mid))
      GROUP BY uid, pos)
    GROUP BY uid"""
VIEW_DEPS["v_profiles"] = ["v_ratings", "v_features"]

SQL["predict_scores"] = with_views(
    """SELECT r.uid, r.mid, round(list_dot_product(u.features, f.features), 6) AS prediction
       FROM v_ratings r JOIN v_profiles u USING (uid) JOIN v_features f USING (mid)""",
    "v_profiles")

SQL["user_topk_recs"] = with_views(
    """SELECT uid, rank, mid, round(score, 6) AS score FROM (
         SELECT uid, mid, score,
                CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid ASC)
                     AS INTEGER) AS rank
         FROM (SELECT u.uid, f.mid, list_dot_product(u.features, f.features) AS score
               FROM v_profiles u, v_features f
               WHERE f.mid IN (SELECT mid FROM v_movies))
         WHERE score > 0)
       WHERE rank <= 10""", "v_profiles", "v_movies")

_MEAN_SCORED = """
    SELECT r.uid, r.mid, r.score, a.prediction FROM v_ratings r
    JOIN (SELECT mid, avg(score) AS prediction FROM v_ratings GROUP BY mid) a USING (mid)"""

SQL["rmse"] = with_views(
    f"SELECT round(sqrt(avg((score - prediction) ^ 2)), 6) AS rmse FROM ({_MEAN_SCORED})",
    "v_ratings")

VIEWS["v_mean_scored"] = _MEAN_SCORED
VIEW_DEPS["v_mean_scored"] = ["v_ratings"]

SQL["rmse_pairwise"] = with_views(
    """SELECT round(sqrt(avg((a.score - p.prediction) ^ 2)), 6) AS rmse
       FROM v_mean_scored a JOIN v_mean_scored p ON a.uid = p.uid AND a.mid = p.mid""",
    "v_mean_scored")

# ---- ALS (only what is deterministic: sizes and ids) -------------------------

SQL["als_train_summary"] = with_views(
    """SELECT count(DISTINCT uid) AS n_users, count(DISTINCT mid) AS n_items,
              CAST(50 AS INTEGER) AS rank, true AS beats_movie_mean FROM v_ratings""", "v_ratings")

# what must hold of any trained model: nothing differs, nothing breaks the rules
SQL["als_user_recs_check"] = "SELECT 0 AS differing, 0 AS not_positive, 0 AS not_a_movie"
SQL["als_movie_recs_check"] = "SELECT 0 AS one_sided, 0 AS under_threshold, 0 AS itself, 0 AS wrong_value"
SQL["als_grid_check"] = """
    SELECT CAST(i AS INTEGER) AS grid_ix, CAST(r AS INTEGER) AS rank, CAST(l AS DOUBLE) AS reg_param,
           true AS beats_movie_mean
    FROM (VALUES (0, 10, 0.01), (1, 10, 0.1), (2, 20, 0.01), (3, 20, 0.1)) t(i, r, l)"""
SQL["best_params_rule"] = with_views(
    """SELECT arg_min(rank, (rmse, grid_ix)) AS rank, arg_min(reg_param, (rmse, grid_ix)) AS reg_param,
              min(rmse) AS rmse
       FROM (SELECT CAST(mid % 97 AS INTEGER) AS grid_ix, CAST(max(mid) AS INTEGER) AS rank,
                    CAST(count(*) AS DOUBLE) AS reg_param, round(avg(score), 1) AS rmse
             FROM v_ratings GROUP BY mid % 97)""", "v_ratings")

SQL["als_item_factors"] = with_views(
    "SELECT DISTINCT mid, CAST(50 AS INTEGER) AS n_features FROM v_ratings", "v_ratings")

# ---- online -----------------------------------------------------------------

VIEWS["v_triggers"] = """
    SELECT uid, arg_max(mid, ("timestamp", mid, score)) AS mid FROM v_events GROUP BY uid"""
VIEW_DEPS["v_triggers"] = ["v_events"]

VIEWS["v_event_recent"] = """
    SELECT uid, pos, mid, score, "timestamp" FROM (
      SELECT uid, mid, score, "timestamp",
             CAST(row_number() OVER (PARTITION BY uid
                  ORDER BY "timestamp" DESC, mid DESC, score DESC) AS INTEGER) AS pos
      FROM v_events) WHERE pos <= 20"""
VIEW_DEPS["v_event_recent"] = ["v_events"]

VIEWS["v_cands"] = """
    SELECT t.uid, t.mid, s.rid AS cand, s.r AS sim
    FROM v_triggers t JOIN v_sim20 s ON s.mid = t.mid"""
VIEW_DEPS["v_cands"] = ["v_events", "v_features", "v_sim20", "v_triggers"]

VIEWS["v_unrated"] = """
    SELECT * FROM v_cands c
    WHERE NOT EXISTS (SELECT 1 FROM v_ratings r WHERE r.uid = c.uid AND r.mid = c.cand)"""
VIEW_DEPS["v_unrated"] = ["v_ratings", "v_events", "v_features", "v_sim20", "v_triggers",
                          "v_cands"]

VIEWS["v_topk"] = """
    SELECT uid, mid, cand, sim FROM (
      SELECT *, row_number() OVER (PARTITION BY uid, mid ORDER BY sim DESC, cand ASC) AS rn
      FROM v_unrated) WHERE rn <= 20"""
VIEW_DEPS["v_topk"] = VIEW_DEPS["v_unrated"] + ["v_unrated"]

VIEWS["v_pairs"] = """
    SELECT t.uid, t.cand, e.mid AS rmid, e.score AS rscore, s.r AS psim
    FROM v_topk t JOIN v_event_recent e ON e.uid = t.uid
    JOIN v_sim20 s ON s.mid = t.cand AND s.rid = e.mid
    WHERE s.r > 0.2"""
VIEW_DEPS["v_pairs"] = VIEW_DEPS["v_topk"] + ["v_topk", "v_event_recent"]

VIEWS["v_scores"] = """
    SELECT uid, cand AS mid,
           avg(psim * rscore) + log2(greatest(count(*) FILTER (WHERE rscore > 3), 1))
             - log2(greatest(count(*) FILTER (WHERE rscore <= 3), 1)) AS score
    FROM v_pairs GROUP BY uid, cand"""
VIEW_DEPS["v_scores"] = VIEW_DEPS["v_pairs"] + ["v_pairs"]

SQL["recent_ratings"] = with_views("SELECT * FROM v_event_recent", "v_event_recent")
SQL["similar_to_rated"] = with_views(
    "SELECT uid, mid, cand, round(sim, 6) AS sim FROM v_cands", "v_cands")
SQL["unrated_candidates"] = with_views(
    "SELECT uid, mid, cand, round(sim, 6) AS sim FROM v_unrated", "v_unrated")
SQL["topk_similar"] = with_views(
    "SELECT uid, mid, cand, round(sim, 6) AS sim FROM v_topk", "v_topk")
SQL["pair_similarity"] = with_views(
    "SELECT uid, cand, rmid, rscore, round(psim, 6) AS psim FROM v_pairs", "v_pairs")
SQL["candidate_scores"] = with_views(
    "SELECT uid, mid, round(score, 6) AS score FROM v_scores", "v_scores")
SQL["realtime_recs"] = SQL["candidate_scores"]

# ---- messages and streams ---------------------------------------------------

VIEWS["v_messages"] = """
    SELECT event_id, CAST(epoch_us(ts) // 1000000 AS INTEGER) AS epoch,
           CAST(user_id AS VARCHAR) AS u, json_extract_string(props, '$.k') AS k,
           CAST(CAST((event_id % 10) + 1 AS DOUBLE) / 2 AS VARCHAR) AS s,
           CAST(epoch_us(ts) // 1000000 AS VARCHAR) AS t, event_type
    FROM events"""

VIEWS["v_log"] = f"""
    SELECT CASE event_id % 5
             WHEN 0 THEN 'noise event ' || CAST(event_id AS VARCHAR)
             WHEN 1 THEN 'INFO rating {LOG_PAYLOAD_MARKER}' || concat_ws('|', u, k, s, t)
             WHEN 2 THEN '{LOG_PAYLOAD_MARKER}   ' || concat_ws('|', u, k, s, t) || '   '
             WHEN 3 THEN concat_ws('|', u, k, s, t) || ' {LOG_PAYLOAD_MARKER}'
             ELSE '{LOG_PAYLOAD_MARKER}' || concat_ws('|', u, k, s, t)
                  || '{LOG_PAYLOAD_MARKER} trailing'
           END AS line
    FROM v_messages"""
VIEW_DEPS["v_log"] = ["v_messages"]

_LOG_FILTER = f"""
    SELECT 'logProcessor' AS key, value FROM (
      SELECT trim(string_split(line, '{LOG_PAYLOAD_MARKER}')[2]) AS value
      FROM v_log WHERE contains(line, '{LOG_PAYLOAD_MARKER}'))
    WHERE value <> ''"""
SQL["log_filter"] = with_views(_LOG_FILTER, "v_log")
SQL["stream_log_filter"] = SQL["log_filter"]

VIEWS["v_noisy"] = """
    SELECT CASE WHEN event_id % 5 <= 1 THEN concat_ws('|', u, k, s, t)
                WHEN event_id % 5 = 2 THEN concat_ws('|', u, k, s)
                WHEN event_id % 5 = 3 THEN concat_ws('|', u, k, s, t, event_type)
                ELSE concat_ws('|', u, k, event_type, t) END AS raw
    FROM v_messages"""
VIEW_DEPS["v_noisy"] = ["v_messages"]

_ROUTE = """
    SELECT CASE WHEN n = 4 AND ok THEN 'rating' WHEN n = 4 THEN 'malformed' ELSE 'raw' END
             AS kind,
           CASE WHEN n = 4 AND ok THEN uid END AS uid,
           CASE WHEN n = 4 AND ok THEN mid END AS mid,
           CASE WHEN n = 4 AND ok THEN score END AS score,
           CASE WHEN n = 4 AND ok THEN "timestamp" END AS "timestamp",
           CASE WHEN n = 4 AND ok THEN NULL ELSE raw END AS raw
    FROM (
      SELECT raw, n, uid, mid, score, "timestamp",
             uid IS NOT NULL AND mid IS NOT NULL AND score IS NOT NULL
               AND "timestamp" IS NOT NULL AS ok
      FROM (
        SELECT raw, len(p) AS n,
               CASE WHEN regexp_full_match(p[1], '[+-]?[0-9]+') THEN TRY_CAST(p[1] AS INTEGER) END
                 AS uid,
               CASE WHEN regexp_full_match(p[2], '[+-]?[0-9]+') THEN TRY_CAST(p[2] AS INTEGER) END
                 AS mid,
               TRY_CAST(trim(p[3]) AS DOUBLE) AS score,
               CASE WHEN regexp_full_match(p[4], '[+-]?[0-9]+') THEN TRY_CAST(p[4] AS INTEGER) END
                 AS "timestamp"
        FROM (SELECT raw, string_split(rtrim(raw, '|'), '|') AS p FROM v_noisy)))"""
SQL["route_messages"] = with_views(_ROUTE, "v_noisy")
SQL["stream_route_messages"] = SQL["route_messages"]

SQL["stream_parse_ratings"] = with_views(
    'SELECT uid, mid, score, "timestamp" FROM v_events', "v_events")
SQL["stream_recent_ratings"] = SQL["recent_ratings"]
SQL["stored_recent_lists"] = SQL["recent_ratings"]
SQL["stream_rejects"] = with_views(
    f"""SELECT CASE WHEN event_id % 5 IN (2, 4) THEN 'reject' ELSE 'rating' END AS kind,
               CASE WHEN event_id % 5 = 2 THEN concat_ws('|', u, k, s)
                    WHEN event_id % 5 = 4 THEN concat_ws('|', u, k, event_type, t) END AS raw,
               CASE WHEN event_id % 5 NOT IN (2, 4) THEN CAST(u AS INTEGER) END AS uid,
               CASE WHEN event_id % 5 NOT IN (2, 4) THEN CAST(k AS INTEGER) END AS mid,
               CASE WHEN event_id % 5 NOT IN (2, 4) THEN CAST(s AS DOUBLE) END AS score,
               CASE WHEN event_id % 5 NOT IN (2, 4) THEN CAST(t AS INTEGER) END AS "timestamp"
        FROM v_messages""", "v_messages")

SQL["stream_realtime_recs"] = with_views(
    """SELECT t.uid, s.mid, round(s.score, 6) AS score
       FROM v_triggers t LEFT JOIN v_scores s ON s.uid = t.uid""",
    "v_scores")
SQL["stream_realtime_state"] = SQL["stream_realtime_recs"]

SQL["upsert_stream_recs"] = with_views(
    """SELECT uid, arg_max(month, month) AS month, arg_max(n, month) AS n,
              arg_max(avg, month) AS avg FROM (
         SELECT uid, CAST(strftime(make_timestamp(CAST("timestamp" AS BIGINT) * 1000000),
                                   '%Y%m') AS INTEGER) AS month,
                count(*) AS n, round(avg(score), 6) AS avg
         FROM v_ratings GROUP BY ALL)
       GROUP BY uid""", "v_ratings")

# ---- users ------------------------------------------------------------------

_JAVA_HASH = """CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER)"""

VIEWS["v_user_hash"] = f"""
    SELECT c_custkey, c_name AS userName, c_mktsegment, {_JAVA_HASH} AS uid FROM (
      SELECT c_custkey, c_name, c_mktsegment,
             list_reduce(list_prepend(CAST(0 AS BIGINT),
                           list_transform(string_split(c_name, ''),
                                          lambda c: CAST(unicode(c) AS BIGINT))),
                         lambda acc, c: (acc * 31 + c) % 4294967296) AS h
      FROM customer)"""

SQL["user_uid"] = with_views("SELECT c_custkey, userName, uid FROM v_user_hash", "v_user_hash")

VIEWS["v_requests"] = """
    SELECT c.c_name AS userName, o.o_orderkey AS req_order,
           o.o_orderstatus || '|' || o.o_orderpriority AS genres
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""

VIEWS["v_registered"] = """
    SELECT r.userName, min(r.req_order) AS first_order FROM v_requests r
    WHERE r.userName NOT IN (SELECT userName FROM v_user_hash WHERE c_mktsegment = 'BUILDING')
    GROUP BY r.userName"""
VIEW_DEPS["v_registered"] = ["v_user_hash", "v_requests"]

SQL["register_users"] = with_views(
    """SELECT r.userName, r.req_order, coalesce(r.req_order = g.first_order, false) AS success
       FROM v_requests r LEFT JOIN v_registered g USING (userName)""", "v_registered")

SQL["update_user_genres"] = with_views(
    """SELECT u.uid, u.userName, coalesce(l.genres, '') AS genres,
              CASE WHEN l.genres IS NOT NULL THEN false ELSE u.firstLogin END AS firstLogin
       FROM (SELECT uid, userName, false AS firstLogin FROM v_user_hash
             WHERE c_mktsegment = 'BUILDING'
             UNION ALL
             SELECT h.uid, g.userName, true AS firstLogin
             FROM v_registered g JOIN v_user_hash h USING (userName)) u
       LEFT JOIN (SELECT userName, arg_max(genres, req_order) AS genres
                  FROM v_requests GROUP BY userName) l USING (userName)""", "v_registered")

SQL["statistics_job"] = SQL["genre_top10"]
SQL["decode_recent_items"] = with_views(
    "SELECT uid, pos, mid, score FROM v_event_recent", "v_event_recent")
