"""Plain-SQL statements of every report, for differential checks with DuckDB.

Each statement runs on the driver tables (pre-registered views) and returns
the same columns, names and types as the Spark query of the same name.
DuckDB notes: integer sums are HUGEINT (cast to BIGINT), ``//`` is floor
division, ``row_number`` is BIGINT (cast to INTEGER like Spark's).
"""

from __future__ import annotations

FACT_CTE = """
pr AS (
  SELECT strftime(o.o_orderdate, '%Y%m%d') AS date,
         CAST(l.l_orderkey AS VARCHAR) AS match_id,
         o.o_orderpriority AS game_mode,
         n.n_name AS map,
         CAST(l.l_linenumber AS INTEGER) AS round_nb,
         CASE WHEN (l.l_orderkey + l.l_linenumber) % 2 = 0 THEN 'Attacker' ELSE 'Defender' END AS win_role,
         CAST(60 + (l.l_orderkey * 7 + l.l_linenumber * 13) % 240 AS INTEGER) AS round_duration,
         CAST(1 + (l.l_suppkey * 3) % 300 AS INTEGER) AS clearance_level,
         CASE WHEN p.p_type IN ('ECONOMY', 'STANDARD') THEN 'Attacker' ELSE 'Defender' END AS role,
         CASE WHEN (CASE WHEN p.p_type IN ('ECONOMY', 'STANDARD') THEN 'Attacker' ELSE 'Defender' END)
                 = (CASE WHEN (l.l_orderkey + l.l_linenumber) % 2 = 0 THEN 'Attacker' ELSE 'Defender' END)
              THEN 1 ELSE 0 END AS has_won,
         p.p_brand || '-' || p.p_type AS operator,
         CAST(CAST(floor(l.l_quantity) AS INTEGER) % 6 AS INTEGER) AS kills,
         CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS is_dead,
         l.l_linestatus AS primary_weapon_type,
         o.o_orderstatus AS platform
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

FACT_COLUMNS = ("date, match_id, game_mode, map, round_nb, win_role, round_duration, "
                "clearance_level, role, has_won, operator, kills, is_dead, primary_weapon_type, "
                "platform")


def half_even(n: str, d: str) -> str:
    """Exact ties-to-even rounding of n/d to 2 places (n, d non-negative integers)."""
    q = f"((100 * ({n})) // ({d}))"
    r = f"((100 * ({n})) % ({d}))"
    return (f"(CAST({q} + CASE WHEN 2 * {r} > ({d}) OR (2 * {r} = ({d}) AND {q} % 2 = 1) "
            f"THEN 1 ELSE 0 END AS DOUBLE) / 100)")


def ratio(n: str, d: str) -> str:
    return f"(CASE WHEN ({d}) = 0 THEN CAST({n} AS DOUBLE) ELSE {half_even(n, d)} END)"


def hms(t: str) -> str:
    return f"printf('%02d:%02d:%02d', ({t}) // 3600, (({t}) % 3600) // 60, ({t}) % 60)"


def day_label(d: str) -> str:
    return f"(substr({d}, 7, 2) || '-' || substr({d}, 5, 2) || '-' || substr({d}, 1, 4))"


def with_fact(body: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {FACT_CTE}{extra}\n{body}"


# --- shared CTEs --------------------------------------------------------------------------

DIVISION_BOARD = f"""
board AS (
  SELECT date, split_part(operator, '-', 1) AS division,
         CAST(sum(5 * kills + 15 * has_won) AS BIGINT) AS points,
         {half_even('sum(clearance_level)', 'count(*)')} AS avg_level,
         CAST(sum(round_duration) AS BIGINT) AS total_time
  FROM pr GROUP BY 1, 2
)"""

OPERATOR_RATIOS = f"""
ops AS (
  SELECT date, operator, min(role) AS role,
         CAST(sum(kills) AS BIGINT) AS kills, CAST(sum(is_dead) AS BIGINT) AS deaths,
         CAST(sum(has_won) AS BIGINT) AS wins, count(*) AS rounds
  FROM pr GROUP BY 1, 2
),
op_ratios AS (
  SELECT date, operator, role, kills, deaths, wins, rounds,
         {ratio('kills', 'deaths')} AS kill_ratio, {ratio('wins', 'rounds')} AS round_ratio
  FROM ops
)"""

PLATFORM_MAP = """
rounds AS (
  SELECT date, platform, map, match_id, round_nb, min(round_duration) AS round_duration
  FROM pr GROUP BY 1, 2, 3, 4, 5
),
pm AS (
  SELECT date, platform, map, count(*) AS rounds, CAST(sum(round_duration) AS BIGINT) AS total_time
  FROM rounds GROUP BY 1, 2, 3
)"""

MAP_OPERATOR = f"""
mo AS (
  SELECT map, operator, role,
         CAST(sum(kills) AS BIGINT) AS kills, CAST(sum(is_dead) AS BIGINT) AS deaths,
         CAST(sum(has_won) AS BIGINT) AS wins, count(*) AS rounds
  FROM pr GROUP BY 1, 2, 3
),
mo_ratios AS (
  SELECT map, operator, role, kills, deaths, wins, rounds,
         {ratio('kills', 'deaths')} AS kill_ratio, {ratio('wins', 'rounds')} AS round_ratio
  FROM mo
)"""

MAP_OPERATOR_AS_WRITTEN = f"""
mo AS (
  SELECT map, operator, min(role) AS role,
         CAST(sum(kills) AS BIGINT) AS kills, CAST(sum(is_dead) AS BIGINT) AS deaths,
         CAST(sum(has_won) AS BIGINT) AS wins, count(*) AS rounds
  FROM pr GROUP BY 1, 2
),
mo_ratios AS (
  SELECT map, operator, role, kills, deaths, wins, rounds,
         {ratio('kills', 'deaths')} AS kill_ratio, {ratio('wins', 'rounds')} AS round_ratio
  FROM mo
)"""

MODE_ROLE_MAP = """
mrm AS (
  SELECT game_mode, role, map, CAST(sum(has_won) AS BIGINT) AS wins FROM pr GROUP BY 1, 2, 3
)"""

# --- statements ---------------------------------------------------------------------------

FACT_PLAYER_ROUNDS = with_fact(f"SELECT {FACT_COLUMNS} FROM pr")

DIVISION_SCOREBOARD = with_fact(
    f"SELECT date, division, points, avg_level, total_time, {hms('total_time')} AS time_hms "
    "FROM board", DIVISION_BOARD)

DIVISION_TOPK = with_fact(f"""
SELECT date, division, points, avg_level, time_hms, rank FROM (
  SELECT date, division, points, avg_level, {hms('total_time')} AS time_hms,
         CAST(row_number() OVER (PARTITION BY date ORDER BY points DESC, division ASC) AS INTEGER) AS rank
  FROM board) WHERE rank <= 5""", DIVISION_BOARD)

OPERATOR_RATIOS_Q = with_fact(
    "SELECT date, operator, role, kills, deaths, wins, rounds, kill_ratio, round_ratio FROM op_ratios",
    OPERATOR_RATIOS)

OPERATOR_TOPK = with_fact("""
SELECT date, operator, role, kill_ratio, round_ratio, rounds, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY date
           ORDER BY kill_ratio / 3 + round_ratio DESC, operator ASC) AS INTEGER) AS rank
  FROM op_ratios) WHERE rank <= 3""", OPERATOR_RATIOS)

ROUND_DEDUPE = with_fact(
    "SELECT date, platform, map, match_id, round_nb, round_duration FROM rounds", PLATFORM_MAP)

PLATFORM_MAP_TIME = with_fact("SELECT date, platform, map, rounds, total_time FROM pm", PLATFORM_MAP)

PLATFORM_SUMMARY = with_fact(f"""
SELECT date, platform, top_map, rounds, total_time, time_on_map, {hms('total_time')} AS time_hms,
       CAST(row_number() OVER (PARTITION BY date ORDER BY total_time DESC, platform ASC) AS INTEGER) AS rank
FROM (
  SELECT date, platform,
         CAST(sum(rounds) AS BIGINT) AS rounds, CAST(sum(total_time) AS BIGINT) AS total_time,
         arg_min(map, (-total_time, map)) AS top_map, max(total_time) AS time_on_map
  FROM pm GROUP BY 1, 2)""", PLATFORM_MAP)

DAILY_PLATFORM_SERIES = with_fact(f"""
SELECT date, {day_label('date')} AS day,
       CAST(sum(CASE WHEN platform = 'F' THEN rounds END) AS BIGINT) AS pc,
       CAST(sum(CASE WHEN platform = 'O' THEN rounds END) AS BIGINT) AS ps4,
       CAST(sum(CASE WHEN platform NOT IN ('F', 'O') THEN rounds END) AS BIGINT) AS xbox
FROM pm GROUP BY date""", PLATFORM_MAP)

OPERATOR_NAME_RATIOS = with_fact(f"""
SELECT operator_name, kills, deaths, wins, rounds,
       {ratio('kills', 'deaths')} AS kill_ratio, {ratio('wins', 'rounds')} AS round_ratio
FROM (
  SELECT split_part(operator, '-', 2) AS operator_name,
         CAST(sum(kills) AS BIGINT) AS kills, CAST(sum(is_dead) AS BIGINT) AS deaths,
         CAST(sum(has_won) AS BIGINT) AS wins, count(*) AS rounds
  FROM pr GROUP BY 1)""")

MODE_ROLE_MAP_WINS = with_fact("SELECT game_mode, role, map, wins FROM mrm", MODE_ROLE_MAP)

MODE_ROLE_BEST_MAP = with_fact("""
SELECT game_mode, role, CAST(sum(wins) AS BIGINT) AS total_wins,
       arg_min(map, (-wins, map)) AS best_map, max(wins) AS wins_on_map
FROM mrm GROUP BY 1, 2""", MODE_ROLE_MAP)

MODE_ROLE_PEAK_MATCH = with_fact("""
SELECT game_mode, role, arg_min(map, (-wins, map)) AS peak_map, max(wins) AS peak_wins
FROM (SELECT game_mode, role, map, match_id, CAST(sum(has_won) AS BIGINT) AS wins
      FROM pr GROUP BY 1, 2, 3, 4)
GROUP BY 1, 2""")

MAP_OPERATOR_STATS = with_fact(
    "SELECT map, operator, role, kills, deaths, wins, rounds, kill_ratio, round_ratio FROM mo_ratios",
    MAP_OPERATOR)

MAP_BEST_OPERATORS = with_fact("""
SELECT map, role, operator, kill_ratio, round_ratio FROM (
  SELECT *, row_number() OVER (PARTITION BY map, role
           ORDER BY kill_ratio / 2 + round_ratio DESC, operator ASC) AS rn
  FROM mo_ratios) WHERE rn = 1""", MAP_OPERATOR)

MAP_BEST_OPERATORS_AS_WRITTEN = with_fact("""
SELECT map, role, operator, kill_ratio, round_ratio FROM (
  SELECT *, row_number() OVER (PARTITION BY map, role
           ORDER BY kill_ratio / 2 + round_ratio DESC, operator ASC) AS rn
  FROM mo_ratios) WHERE rn = 1""", MAP_OPERATOR_AS_WRITTEN)

MAP_BEST_BY_DAY = with_fact(f"""
SELECT date, map, role, operator, kill_ratio, round_ratio FROM (
  SELECT *, row_number() OVER (PARTITION BY date, map, role
           ORDER BY kill_ratio / 2 + round_ratio DESC, operator ASC) AS rn
  FROM (SELECT date, map, operator, role, {ratio('kills', 'deaths')} AS kill_ratio,
               {ratio('wins', 'rounds')} AS round_ratio
        FROM (SELECT date, map, operator, role,
                     CAST(sum(kills) AS BIGINT) AS kills, CAST(sum(is_dead) AS BIGINT) AS deaths,
                     CAST(sum(has_won) AS BIGINT) AS wins, count(*) AS rounds
              FROM pr GROUP BY 1, 2, 3, 4)))
WHERE rn = 1""")

STATEMENTS = {
    "fact_player_rounds": FACT_PLAYER_ROUNDS,
    "division_scoreboard": DIVISION_SCOREBOARD,
    "division_topk": DIVISION_TOPK,
    "operator_ratios": OPERATOR_RATIOS_Q,
    "operator_topk": OPERATOR_TOPK,
    "round_dedupe": ROUND_DEDUPE,
    "platform_map_time": PLATFORM_MAP_TIME,
    "platform_summary": PLATFORM_SUMMARY,
    "daily_platform_series": DAILY_PLATFORM_SERIES,
    "operator_name_ratios": OPERATOR_NAME_RATIOS,
    "mode_role_map_wins": MODE_ROLE_MAP_WINS,
    "mode_role_best_map": MODE_ROLE_BEST_MAP,
    "mode_role_peak_match": MODE_ROLE_PEAK_MATCH,
    "map_operator_stats": MAP_OPERATOR_STATS,
    "map_best_operators": MAP_BEST_OPERATORS,
    "map_best_by_day": MAP_BEST_BY_DAY,
}


# --- codecs, store, sequence, report files ------------------------------------------------

def _j(col: str) -> str:
    return f"CAST(to_json({col}) AS VARCHAR)"


WIRE_VALUE_SQL = (
    "'[[' || " + " || ', ' || ".join([_j("date"), _j("match_id")]) + " || '], [' || "
    + " || ', ' || ".join([
        _j("game_mode"), _j("map"), "CAST(round_nb AS VARCHAR)", _j("win_role"),
        _j("CAST(round_duration AS VARCHAR)"), _j("CAST(clearance_level AS VARCHAR)"),
        _j("role"), "CAST(has_won AS VARCHAR)", _j("operator"), "CAST(kills AS VARCHAR)",
        "CAST(is_dead AS VARCHAR)", _j("primary_weapon_type"), _j("platform")])
    + " || ']]'")

WIRE_ENCODE = with_fact(f"SELECT date, match_id, {WIRE_VALUE_SQL} AS value FROM pr")

_LEGACY_FIELDS = ["date", "match_id", "game_mode", "map", "round_nb", "win_role",
                  "round_duration", "clearance_level", "role", "has_won", "operator", "kills",
                  "is_dead", "primary_weapon_type", "platform"]
_LEGACY_INTS = {"round_nb", "round_duration", "clearance_level", "has_won", "kills", "is_dead"}
LEGACY_TOKENS = f"""
tok AS (
  SELECT string_split(translate({WIRE_VALUE_SQL}, '[],''"', ''), ' ') AS t FROM pr
)"""
_legacy_bad_int = " OR ".join(
    f"(t[{i + 1}] IS NOT NULL AND TRY_CAST(trim(t[{i + 1}]) AS INTEGER) IS NULL)"
    for i, f in enumerate(_LEGACY_FIELDS) if f in _LEGACY_INTS)
_legacy_cols = ", ".join(
    (f"TRY_CAST(trim(t[{i + 1}]) AS INTEGER) AS {f}" if f in _LEGACY_INTS else f"t[{i + 1}] AS {f}")
    for i, f in enumerate(_LEGACY_FIELDS))

WIRE_DECODE_LEGACY = with_fact(
    f"SELECT {_legacy_cols} FROM tok WHERE len(t) = 15 AND NOT ({_legacy_bad_int})", LEGACY_TOKENS)

WIRE_DECODE_REJECTS = with_fact(f"""
SELECT CASE WHEN len(t) <> 15 THEN 'arity' ELSE 'bad_int' END AS error, count(*) AS rows
FROM tok WHERE len(t) <> 15 OR ({_legacy_bad_int}) GROUP BY 1""", LEGACY_TOKENS)

SCAN_DAY = with_fact(f"SELECT {FACT_COLUMNS} FROM pr WHERE date = '19980301'")

MATCH_SEQUENCE = with_fact("""
SELECT date, match_id, seq, match_in_day, CASE WHEN match_in_day > 1 THEN 1 ELSE 0 END AS pause_before
FROM (
  SELECT date, match_id,
         row_number() OVER (ORDER BY date, match_id) AS seq,
         row_number() OVER (PARTITION BY date ORDER BY match_id) AS match_in_day
  FROM (SELECT DISTINCT date, match_id FROM pr))""")

_DIV_LINE = ("'Divisione: ' || division || ',  Punti: ' || CAST(points AS VARCHAR) || "
             "',  Livello medio giocatori: ' || CAST(avg_level AS VARCHAR) || "
             "',  Tempo totale giocato: ' || time_hms")
_OP_LINE = ("'Operatore: ' || operator || ',  Ruolo: ' || role || ',  killRatio: ' || "
            "CAST(kill_ratio AS VARCHAR) || ',  roundRatio: ' || CAST(round_ratio AS VARCHAR) || "
            "',  Round totali giocati: ' || CAST(rounds AS VARCHAR)")
_PLAT_LINE = ("'Piattaforma: ' || platform || ',  Mappa più giocata: ' || top_map || "
              "',  Totale round giocati: ' || CAST(rounds AS VARCHAR) || "
              "',  Tempo di gioco totale: ' || time_hms")

REPORT_CTES = (DIVISION_BOARD, OPERATOR_RATIOS, PLATFORM_MAP, f"""
div AS (
  SELECT * FROM (
    SELECT date, division, points, avg_level, {hms('total_time')} AS time_hms,
           CAST(row_number() OVER (PARTITION BY date ORDER BY points DESC, division) AS INTEGER) AS rank
    FROM board) WHERE rank <= 5
),
opk AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY date
             ORDER BY kill_ratio / 3 + round_ratio DESC, operator) AS INTEGER) AS rank
    FROM op_ratios) WHERE rank <= 3
),
plat AS (
  SELECT date, platform, top_map, rounds, {hms('total_time')} AS time_hms,
         CAST(row_number() OVER (PARTITION BY date ORDER BY total_time DESC, platform) AS INTEGER) AS rank
  FROM (SELECT date, platform, CAST(sum(rounds) AS BIGINT) AS rounds,
               CAST(sum(total_time) AS BIGINT) AS total_time,
               arg_min(map, (-total_time, map)) AS top_map
        FROM pm GROUP BY 1, 2)
),
days AS (SELECT DISTINCT date FROM pr),
lines AS (
  SELECT date, 0 AS section, 1 AS item, date AS value FROM days
  UNION ALL SELECT date, 2, 1, '' FROM days
  UNION ALL SELECT date, 4, 1, '' FROM days
  UNION ALL SELECT date, 1, rank, {_DIV_LINE} FROM div
  UNION ALL SELECT date, 3, rank, {_OP_LINE} FROM opk
  UNION ALL SELECT date, 5, rank, {_PLAT_LINE} FROM plat
)""")

REPORT_LINES = with_fact("SELECT date, section, item, value FROM lines", *REPORT_CTES)

DAILY_REPORT_ALL = with_fact(
    "SELECT date, section, item, value FROM lines WHERE date < (SELECT max(date) FROM pr)",
    *REPORT_CTES)

LATEST_CLOSED_DATE = with_fact("SELECT max(date) AS latest_date FROM pr WHERE date < (SELECT max(date) FROM pr)")

LATEST_PER_KEY = MAP_BEST_BY_DAY.replace(
    "SELECT date, map, role, operator, kill_ratio, round_ratio FROM (",
    "SELECT date, map, role, operator, kill_ratio, round_ratio FROM (\n"
    "SELECT *, row_number() OVER (PARTITION BY map, role ORDER BY date DESC) AS latest FROM (\n"
    "SELECT date, map, role, operator, kill_ratio, round_ratio FROM (", 1) + ")) WHERE latest = 1"

STREAM_DAY_CLOSE = """
SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, count(*) AS n
FROM events
WHERE date_trunc('day', ts) < (SELECT max(date_trunc('day', ts)) FROM events)
GROUP BY 1, 2"""

STATEMENTS.update({
    "wire_encode": WIRE_ENCODE,
    "wire_decode": FACT_PLAYER_ROUNDS,
    "wire_decode_legacy": WIRE_DECODE_LEGACY,
    "wire_decode_rejects": WIRE_DECODE_REJECTS,
    "csv_roundtrip": FACT_PLAYER_ROUNDS,
    "scan_day": SCAN_DAY,
    "match_sequence": MATCH_SEQUENCE,
    "report_lines": REPORT_LINES,
    "latest_closed_date": LATEST_CLOSED_DATE,
    "latest_per_key": LATEST_PER_KEY,
    "stream_operator_ratios": OPERATOR_NAME_RATIOS,
    "stream_mode_role_wins": MODE_ROLE_BEST_MAP,
    "stream_map_best": MAP_BEST_OPERATORS,
    "stream_store_roundtrip": FACT_PLAYER_ROUNDS,
    "stream_day_close": STREAM_DAY_CLOSE,
    "daily_report_all": DAILY_REPORT_ALL,
})


# --- as-written variants -------------------------------------------------------------------

OPERATOR_TOPK_SINGLE_ROW_ZERO = with_fact(f"""
SELECT date, operator, role, kill_ratio, round_ratio, rounds, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY date
           ORDER BY kill_ratio / 3 + round_ratio DESC, operator ASC) AS INTEGER) AS rank
  FROM (SELECT date, operator, role, rounds,
               CASE WHEN rounds = 1 THEN 0.0 ELSE {ratio('kills', 'deaths')} END AS kill_ratio,
               CASE WHEN rounds = 1 THEN 0.0 ELSE {ratio('wins', 'rounds')} END AS round_ratio
        FROM ops)) WHERE rank <= 3""", OPERATOR_RATIOS)

MAP_BEST_OPERATORS_BOTH_ROLES = with_fact("""
SELECT map, role, operator, kill_ratio, round_ratio FROM (
  SELECT *, count(*) OVER (PARTITION BY map) AS roles FROM (
    SELECT *, row_number() OVER (PARTITION BY map, role
             ORDER BY kill_ratio / 2 + round_ratio DESC, operator ASC) AS rn
    FROM mo_ratios) WHERE rn = 1)
WHERE roles = 2""", MAP_OPERATOR)

STATEMENTS.update({
    "operator_topk_single_row_zero": OPERATOR_TOPK_SINGLE_ROW_ZERO,
    "map_best_operators_both_roles": MAP_BEST_OPERATORS_BOTH_ROLES,
    "map_best_operators_as_written": MAP_BEST_OPERATORS_AS_WRITTEN,
})


# --- the one live query, its store and match-by-match replay ---------------------------------

REPLAY_ORDER = with_fact("""
SELECT date, match_id, CAST((seq - 1) // ceil(n / 6.0)::BIGINT AS BIGINT) AS step FROM (
  SELECT *, row_number() OVER (ORDER BY date, match_id) AS seq, count(*) OVER () AS n
  FROM (SELECT DISTINCT date, match_id FROM pr))""")

STREAM_SINGLE_REPORTS = f"""
SELECT 'T1' AS report, operator_name AS key1, '' AS key2, '' AS name, kill_ratio::DOUBLE AS value1,
  round_ratio::DOUBLE AS value2 FROM ({OPERATOR_NAME_RATIOS})
UNION ALL SELECT 'T2', game_mode, role, best_map, total_wins::DOUBLE, wins_on_map::DOUBLE FROM ({MODE_ROLE_BEST_MAP})
UNION ALL SELECT 'T2 peak', game_mode, role, peak_map, peak_wins::DOUBLE, 0::DOUBLE FROM ({MODE_ROLE_PEAK_MATCH})
UNION ALL SELECT 'T3', map, role, operator, kill_ratio::DOUBLE, round_ratio::DOUBLE FROM ({MAP_BEST_OPERATORS})"""

STATEMENTS.update({
    "stream_single_reports": STREAM_SINGLE_REPORTS,
    "stream_store_compact": FACT_PLAYER_ROUNDS,
    "daily_report_late": DAILY_REPORT_ALL,
    "replay_order": REPLAY_ORDER,
})
