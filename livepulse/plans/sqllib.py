"""DuckDB SQL building blocks for the oracle queries.

Each named block is a CTE; ``sql(query, *blocks)`` prepends the blocks a query
needs (and their dependencies) in order. These mirror the profile views and
the bronze → silver → gold steps in plain SQL.
"""

from __future__ import annotations


def lj(col: str) -> str:
    """array → text, nulls shown as NULL (same as Spark array_join(col, '|', 'NULL'))."""
    return f"array_to_string(list_transform({col}, lambda x: coalesce(CAST(x AS VARCHAR), 'NULL')), '|')"


BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {}


def block(name: str, deps: tuple[str, ...], body: str) -> None:
    BLOCKS[name] = (deps, body)


block("e_snap", (), """
SELECT CAST(e.user_id AS VARCHAR) AS stream_id,
       CASE WHEN e.user_id % 10 = 0 THEN NULL ELSE c.c_name END AS user_name,
       CASE WHEN e.event_type = 'error' THEN '  ' ELSE e.event_type END AS game_name,
       e.props AS title,
       CAST(round(e.value * 100) AS BIGINT) AS viewer_count,
       e.ts AS ingestion_ts,
       date_trunc('day', e.ts) AS started_at,
       n.n_name AS language,
       concat('https://img.example/', CAST(e.user_id AS VARCHAR), '-{width}x{height}.jpg') AS thumbnail_url,
       CASE WHEN e.event_type = 'view' THEN NULL
            ELSE list_value(concat(' ', upper(e.event_type), ' '), c.c_mktsegment,
                            concat('K', json_extract_string(e.props, '$.k'))) END AS tags
FROM events e
JOIN customer c ON e.user_id = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey""")

block("e_bronze", ("e_snap",), """
SELECT *, CAST(year(ingestion_ts) AS INTEGER) AS year, CAST(month(ingestion_ts) AS INTEGER) AS month,
       CAST(day(ingestion_ts) AS INTEGER) AS day
FROM e_snap""")

block("e_silver", ("e_bronze",), r"""
SELECT * EXCLUDE (tags),
       CAST(year(started_at) AS INTEGER) AS started_year, CAST(month(started_at) AS INTEGER) AS started_month,
       CAST(day(started_at) AS INTEGER) AS started_day, CAST(hour(started_at) AS INTEGER) AS started_hour,
       CAST(hour(ingestion_ts) AS INTEGER) AS ingestion_hour,
       regexp_replace(thumbnail_url, '\{width\}x\{height\}', '1920x1080', 'g') AS thumbnail_url_1080p,
       epoch_us(ingestion_ts) // 1000000 - epoch_us(started_at) // 1000000 AS stream_time_seconds
FROM e_bronze""")

block("e_tags", ("e_snap",), """
SELECT stream_id, ingestion_ts, lower(trim(t.tag)) AS tag_name
FROM e_snap, unnest(tags) AS t(tag)""")

block("s_snap", (), """
SELECT CAST(l.l_suppkey AS VARCHAR) AS stream_id,
       n.n_name AS user_name,
       p.p_name AS game_name,
       l.l_returnflag AS title,
       CAST(l.l_quantity AS BIGINT) AS viewer_count,
       date_trunc('year', l.l_shipdate) + to_hours(l.l_linenumber % 2) AS ingestion_ts,
       l.l_shipdate AS started_at,
       r.r_name AS language
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN part p ON l.l_partkey = p.p_partkey""")

block("s_bronze", ("s_snap",), """
SELECT *, CAST(year(ingestion_ts) AS INTEGER) AS year, CAST(month(ingestion_ts) AS INTEGER) AS month,
       CAST(day(ingestion_ts) AS INTEGER) AS day
FROM s_snap""")

block("s_silver", ("s_bronze",), """
SELECT *,
       CAST(year(started_at) AS INTEGER) AS started_year, CAST(month(started_at) AS INTEGER) AS started_month,
       CAST(day(started_at) AS INTEGER) AS started_day, CAST(hour(started_at) AS INTEGER) AS started_hour,
       CAST(hour(ingestion_ts) AS INTEGER) AS ingestion_hour,
       epoch_us(ingestion_ts) // 1000000 - epoch_us(started_at) // 1000000 AS stream_time_seconds
FROM s_bronze""")

block("s_clean", ("s_silver",), """
SELECT * REPLACE (coalesce(user_name, 'Unknown') AS user_name, coalesce(language, 'Unknown') AS language)
FROM s_silver
WHERE game_name IS NOT NULL AND trim(game_name) <> ''""")

block("s_fact", ("s_clean",), """
SELECT game_name, user_name, language,
       CAST(year AS BIGINT) * 10000 + month * 100 + day AS date_id,
       ingestion_hour AS time_hour,
       CAST(max(viewer_count) AS BIGINT) AS max_viewers,
       CAST(sum(viewer_count) AS DOUBLE) AS sum_viewers,
       count(viewer_count) AS count_observations
FROM s_clean
GROUP BY game_name, user_name, language, date_id, time_hour""")

block("s_games", (), """
SELECT CAST(o.o_orderdate AS TIMESTAMP) AS ingestion_ts,
       l.l_orderkey * 10 + l.l_linenumber AS version_tiebreak,
       CAST(p.p_partkey AS VARCHAR) AS game_id,
       p.p_name AS game_name,
       CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE CAST(p.p_partkey + 1000 AS VARCHAR) END AS igdb_id,
       CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE p.p_type END AS summary,
       CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE CAST(p.p_size * 2 AS DOUBLE) END AS total_rating,
       CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE CAST((p.p_partkey + l.l_linenumber) % 200 AS INTEGER) END
            AS total_rating_count,
       CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE p.p_brand END AS storyline,
       CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE concat('https://games.example/', CAST(p.p_partkey AS VARCHAR)) END AS url,
       CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE
            CAST(make_date(CAST(1985 + p.p_partkey % 38 AS INTEGER), CAST(1 + p.p_partkey % 12 AS INTEGER), 1) AS TIMESTAMP)
            END AS first_release_date,
       CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE string_split(p.p_name, ' ') END AS themes,
       CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE list_value('Perspective ' || CAST(p.p_size % 3 AS VARCHAR)) END
            AS player_perspectives,
       CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE list_value(p.p_brand, p.p_type) END AS keywords,
       CASE WHEN p.p_partkey % 7 = 0 THEN NULL WHEN p.p_size % 5 = 0 THEN CAST([] AS VARCHAR[])
            ELSE list_value('Mode ' || CAST(p.p_size % 4 AS VARCHAR), 'Single player') END AS game_modes,
       CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE list_value(p.p_type, 'PC') END AS platforms,
       CASE WHEN p.p_partkey % 7 = 0 THEN NULL
            WHEN p.p_size % 4 = 0 THEN list_value(NULL, 'Family 1')
            WHEN p.p_size % 3 = 1 THEN list_value('Family 1')
            ELSE list_value('Family ' || CAST(p.p_size % 3 AS VARCHAR), 'Family 1') END AS platform_families,
       CASE WHEN p.p_partkey % 7 = 0 THEN NULL
            WHEN p.p_size % 2 = 0 THEN list_value('Type 0')
            ELSE list_value('Type 1', 'Type 0') END AS platform_types
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey""")

# latest catalogue row per game_id / per game_name
block("s_latest_games", ("s_games",), """
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY ingestion_ts DESC, version_tiebreak DESC) AS _rn
  FROM s_games) WHERE _rn = 1""")

block("s_games_by_name", ("s_games",), """
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY game_name ORDER BY ingestion_ts DESC, version_tiebreak DESC) AS _rn
  FROM s_games WHERE game_name IS NOT NULL) WHERE _rn = 1""")

block("s_dim_game", ("s_clean", "s_games_by_name"), """
SELECT d.game_name, g.igdb_id, g.total_rating, CAST(g.total_rating_count AS BIGINT) AS total_rating_count,
       g.first_release_date, g.themes, g.keywords, g.platforms
FROM (SELECT DISTINCT game_name FROM s_clean) d
LEFT JOIN s_games_by_name g ON d.game_name = g.game_name""")

block("s_star", ("s_fact", "s_dim_game"), """
SELECT f.*, g.igdb_id, g.total_rating, g.total_rating_count, g.first_release_date,
       g.themes, g.keywords, g.platforms,
       make_timestamp(CAST(f.date_id // 10000 AS BIGINT), CAST(f.date_id // 100 % 100 AS BIGINT),
                      CAST(f.date_id % 100 AS BIGINT), CAST(f.time_hour AS BIGINT), 0, 0) AS row_datetime
FROM s_fact f JOIN s_dim_game g ON f.game_name = g.game_name""")


def _order(names):
    seen, out = set(), []

    def visit(n):
        if n in seen:
            return
        seen.add(n)
        for d in BLOCKS[n][0]:
            visit(d)
        out.append(n)
    for n in names:
        visit(n)
    return out


def sql(query: str, *blocks: str) -> str:
    if not blocks:
        return query.strip()
    ctes = ",\n".join(f"{n} AS ({BLOCKS[n][1].strip()})" for n in _order(blocks))
    return f"WITH {ctes}\n{query.strip()}"
