"""Common table expressions that the queries' SQL shares, from the raw tables on."""

from ticklore.operators.chat import STOP_WORDS
from ticklore.operators.sentiment import BOOSTERS, LOWERING_PAIRS, NEGATIONS, PHRASES

EV = """
e AS (SELECT (us // 86400000000) * 8 + user_id % 8 AS session_id, user_id, event_id AS idx, us % 86400000000 AS tick, event_type, value,
  '64:' || (user_id % 40) AS player_key FROM (SELECT *, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS us FROM events)),
s AS (SELECT DISTINCT session_id, 'map_' || (session_id % 7) AS map, 'srv ' || (session_id % 3) AS server, CASE WHEN session_id % 5 <> 0 THEN 86400000000 END AS ticks FROM e),
pe AS (SELECT *, CASE event_type WHEN 'error' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 1 ELSE 2 END AS kind FROM e),
nx AS (SELECT *, lead(tick) OVER (PARTITION BY session_id, user_id ORDER BY tick, kind, idx) AS nt, max(tick) OVER (PARTITION BY session_id, user_id) AS lt FROM pe),
al AS (SELECT session_id, user_id, player_key, CASE event_type WHEN 'signup' THEN 'soldier' ELSE 'demoman' END AS class, tick AS start_tick, coalesce(nt, ticks, lt) AS end_tick
  FROM nx JOIN s USING (session_id) WHERE kind = 2 AND coalesce(nt, ticks, lt) > tick),
sc AS (SELECT *, CASE WHEN event_type = 'view' THEN 0 ELSE 1 END AS k, max(tick) OVER (PARTITION BY session_id, user_id) AS lt FROM e WHERE event_type <> 'error'),
sl AS (SELECT *, lag(k) OVER w AS pk, min(CASE WHEN k = 1 THEN tick END) OVER (PARTITION BY session_id, user_id ORDER BY tick, k, idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS stop
  FROM sc WINDOW w AS (PARTITION BY session_id, user_id ORDER BY tick, k, idx)),
sp AS (SELECT session_id, user_id, player_key, tick AS start_tick, coalesce(stop, ticks, lt) AS end_tick FROM sl JOIN s USING (session_id) WHERE k = 0 AND coalesce(pk, 1) = 1 AND coalesce(stop, ticks, lt) > tick)
"""
MG = """
{0}f AS (SELECT session_id, player_key, start_tick, end_tick, max(end_tick) OVER (PARTITION BY session_id, player_key ORDER BY start_tick, end_tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM {0}),
{0}g AS (SELECT *, sum(CASE WHEN far IS NULL OR start_tick > far THEN 1 ELSE 0 END) OVER (PARTITION BY session_id, player_key ORDER BY start_tick, end_tick ROWS UNBOUNDED PRECEDING) AS g FROM {0}f),
{0}m AS (SELECT session_id, player_key, min(start_tick) AS start_tick, max(end_tick) AS end_tick FROM {0}g GROUP BY session_id, player_key, g)
"""
CV = """
ix AS (SELECT DISTINCT conv_id AS id, 'http://x/' || conv_id AS url, 1704067200.0::DOUBLE + conv_id * 86400 AS date, conv_id % 5 <> 0 AS processed, conv_id % 10 = 0 AS failed, CASE WHEN conv_id % 10 = 0 THEN 'invalid' END AS failure_reason FROM conversations),
ss AS (SELECT DISTINCT conv_id AS session_id, 'map_' || (conv_id % 7) AS map, 'srv ' || (conv_id % 3) AS server FROM conversations),
ch AS (SELECT conv_id AS session_id, turn AS "index", role || ' : ' || text AS text, text AS body, role AS from_name, CASE role WHEN 'user' THEN 1 WHEN 'assistant' THEN 2 ELSE 3 END AS uid FROM conversations),
us AS (SELECT DISTINCT session_id, uid, from_name AS name, 76561197960265728 + 2 * uid + session_id % 4 AS id64, from_name = 'system' AS is_bot, uid % 2 AS entity FROM ch)
"""
STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
TOK = "list_filter(regexp_extract_all(lower({0}), '[a-z0-9'']+'), lambda x: length(x) >= 2)"
COUNTS = """
cc AS (SELECT c.session_id, map, server, make_timestamp((date * 1000000)::BIGINT) AS t FROM ch c JOIN ss USING (session_id) JOIN ix ON id = c.session_id),
ct AS (SELECT grouping, key, count(*) AS value FROM (
  SELECT 'map' AS grouping, map AS key FROM cc UNION ALL SELECT 'server', server FROM cc UNION ALL SELECT 'month', strftime(t, '%Y-%m') FROM cc
  UNION ALL SELECT 'day', strftime(t, '%Y-%m-%d') FROM cc UNION ALL SELECT 'hour', strftime(t, '%H') FROM cc UNION ALL SELECT 'weekday', strftime(t, '%A') FROM cc) GROUP BY ALL)
"""
REC = """
r AS (SELECT session_id, idx AS chat_index, user_id, cs, idx % 12 AS k, 'user_' || user_id || CASE WHEN idx % 12 = 11 AND user_id % 9 = 4 THEN ' (no WR)' ELSE '' END AS player, CASE WHEN user_id % 13 = 5 THEN 'Scout' WHEN user_id % 13 = 7 THEN 'demo' WHEN user_id % 2 = 0 THEN 'Solly' ELSE 'Demo' END AS class, CASE WHEN idx % 12 IN (9, 10, 11) THEN 'map_' || (user_id % 5) ELSE 'map_' || (session_id % 7) END AS map_name, '64:' || (user_id % 40) AS record_key, CASE WHEN idx % 12 <> 11 OR user_id % 9 <> 4 OR idx % 5 <> 0 THEN (user_id % 40)::VARCHAR END AS player_id, CASE WHEN idx % 12 = 11 AND user_id % 9 = 4 THEN 'SR' ELSE 'WR' END AS record_type,
  1704067200.0::DOUBLE + (session_id // 8) * 86400 AS date,
  CASE WHEN cs >= 360000 THEN (cs // 360000) || ':' ELSE '' END || lpad(((cs // 6000) % 60)::VARCHAR, 2, '0') || ':' || lpad(((cs // 100) % 60)::VARCHAR, 2, '0') || '.' || lpad((cs % 100)::VARCHAR, 2, '0') AS tm
  FROM (SELECT *, round(value * 100)::INT + 1 AS cs FROM e)),
rr AS (SELECT *, CASE k WHEN 0 THEN 'MapRecord' WHEN 1 THEN 'MapRecord' WHEN 2 THEN 'FirstRecord' WHEN 3 THEN 'Bonus 1' WHEN 4 THEN 'Bonus 1 First' WHEN 5 THEN 'Course 2' WHEN 6 THEN 'C2 - Jump One' WHEN 7 THEN 'MapRun'
  WHEN 9 THEN 'IRCSet' WHEN 10 THEN 'Ranked' WHEN 11 THEN 'Compact' END AS source, k = 10 AS inferred, k >= 10 AS is_lookup,
  CASE WHEN k IN (3, 4) THEN 'Bonus 1' WHEN k = 5 THEN 'Course 2' WHEN k = 6 THEN 'C2 - Jump One' ELSE 'Map' END AS seg,
  CASE WHEN k >= 10 THEN 'command' WHEN k = 9 THEN 'announcement' ELSE 'record' END AS kind,
  CASE WHEN k = 10 THEN 100 WHEN k IN (0, 1) THEN 1 WHEN k = 2 THEN 2 WHEN k = 11 THEN 3 WHEN k = 9 THEN 4 WHEN k = 7 THEN 5 ELSE 50 END AS p FROM r WHERE k <> 8),
ok AS (SELECT * FROM rr WHERE record_type = 'WR' AND class IN ('Solly', 'Demo'))
"""
#: What the export says of a row of REC.
SAID = """
CASE WHEN k IN (0, 1) THEN 'map_record' WHEN k = 2 THEN 'first_record' WHEN k = 4 THEN 'zone_first' WHEN k IN (3, 5, 6) THEN 'zone_record' WHEN k = 7 THEN 'map_run' WHEN k = 9 THEN 'irc_set' WHEN k = 10 THEN 'rank_command' ELSE 'wr_command' END AS evidence_source,
tm AS record_time, CASE WHEN k = 7 THEN tm END AS run_time, CASE WHEN k IN (0, 3, 6, 7) THEN '-00:00.10' WHEN k = 5 THEN '-00:00.25' END AS split, CASE WHEN k = 3 THEN '00:00.10' END AS improvement
"""


def fold(by: str, rows: str = "ok") -> str:
    """CTEs d, o, f: the plain fold of REC, row by row, in groups of the columns `by`: independent of the anchors that the operator splits at."""
    same = " AND ".join(f"o.{c.strip()} = f.{c.strip()}" for c in by.split(","))
    f_cols = ", ".join(f"o.{c.strip()}" for c in by.split(","))
    better = "(o.cs < f.cur - o.inferred::INT OR (o.cs > f.cur AND NOT o.inferred AND (o.kind = 'record' OR o.source = 'IRCSet')))"
    return f"""d AS (SELECT *, max(kind = 'record') OVER (PARTITION BY {by}, cs) AS sure FROM {rows}),
      o AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY date, session_id, chat_index, p, cs) AS n FROM d WHERE kind = 'record' OR NOT sure),
      f AS (SELECT {by}, n, chat_index, cs, cs AS cur, true AS kept FROM o WHERE n = 1
        UNION ALL SELECT {f_cols}, o.n, o.chat_index, o.cs, CASE WHEN {better} THEN o.cs ELSE f.cur END, {better} FROM f JOIN o ON {same} AND o.n = f.n + 1)"""


def days(by: str) -> str:
    """CTEs h, hd after fold(): the kept rows, one of each day and time."""
    return f"""h AS (SELECT rr.* FROM f JOIN rr USING (chat_index) WHERE kept),
      hd AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY {by}, date // 86400, cs ORDER BY CASE kind WHEN 'record' THEN 0 WHEN 'announcement' THEN 1 ELSE 2 END, session_id, chat_index) = 1)"""


#: Ticks by class of each player and session.
PER = """v AS (SELECT DISTINCT session_id, user_id, player_key FROM e), t AS (SELECT session_id, user_id, sum(CASE WHEN class = 'soldier' THEN end_tick - start_tick ELSE 0 END) AS so, sum(CASE WHEN class = 'demoman' THEN end_tick - start_tick ELSE 0 END) AS de FROM al GROUP BY ALL),
q AS (SELECT session_id, player_key, sum(coalesce(so, 0)) AS so, sum(coalesce(de, 0)) AS de FROM v LEFT JOIN t USING (session_id, user_id) GROUP BY ALL)"""
#: Rows of w (player_key, map, server, t, v) under each of six keys.
SIX = """SELECT player_key, 'map' AS grouping, map AS key, v FROM w UNION ALL SELECT player_key, 'server', server, v FROM w UNION ALL SELECT player_key, 'month', strftime(t, '%Y-%m'), v FROM w
UNION ALL SELECT player_key, 'day', strftime(t, '%Y-%m-%d'), v FROM w UNION ALL SELECT player_key, 'hour', strftime(t, '%H'), v FROM w UNION ALL SELECT player_key, 'weekday', strftime(t, '%A'), v FROM w"""
#: Words of the conversations as a lexicon, and the score of each of their messages, by the words before and after each word.
SCORED = """
lt AS (SELECT unnest(list_filter(regexp_extract_all(lower(text), '[a-z0-9'']+'), lambda x: length(x) >= 2)) AS token FROM conversations),
lx AS (SELECT token, (length(token) % 7 - 3) / 2.0::DOUBLE AS valence FROM (SELECT token, count(*) AS n FROM lt GROUP BY 1) WHERE n >= 5 AND token NOT IN ({stop}) AND length(token) % 7 <> 3),
bo AS (SELECT * FROM (VALUES {boosters}) AS b(word, up)), ph AS (SELECT * FROM (VALUES {phrases}) AS p(phrase, v)),
wt AS (SELECT session_id, "index", t, unnest(t) AS x, generate_subscripts(t, 1) AS i FROM (SELECT session_id, "index", list_filter(list_transform(regexp_split_to_array(body, '\\s+'), lambda w:
  CASE WHEN length(regexp_replace(w, '^[[:punct:]]+|[[:punct:]]+$', '', 'g')) > 2 THEN regexp_replace(w, '^[[:punct:]]+|[[:punct:]]+$', '', 'g') ELSE w END), lambda w: w <> '') AS t FROM ch)),
wl AS (SELECT session_id, "index", i, x, lower(x) AS token, x = upper(x) AND x <> lower(x) AS loud, len(list_filter(t, lambda y: y = upper(y) AND y <> lower(y))) BETWEEN 1 AND len(t) - 1 AS mixed, list_position(list_transform(t, lambda y: lower(y)), 'but') AS but FROM wt),
wn AS (SELECT wl.*, lx.valence, coalesce(bo.up, 0) AS up, token IN ({neg}) OR contains(token, 'n''t') AS neg FROM wl LEFT JOIN lx USING (token) LEFT JOIN bo ON bo.word = token),
wz AS (SELECT *, {lags}, lead(token, 1) OVER z AS n1, lead(token, 2) OVER z AS n2, lead(valence, 1) OVER z AS nv FROM wn WINDOW z AS (PARTITION BY session_id, "index" ORDER BY i)),
w0 AS (SELECT *, CASE WHEN coalesce(w1 = 'no', false) OR coalesce(w2 = 'no', false) OR coalesce(w3 = 'no' AND w1 IN ('or', 'nor'), false) THEN valence * -0.74::DOUBLE WHEN token = 'no' AND nv IS NOT NULL THEN 0 ELSE valence END AS c0 FROM wz WHERE valence IS NOT NULL),
wc AS (SELECT *, CASE WHEN mixed AND loud THEN c0 + CASE WHEN c0 > 0 THEN 0.733::DOUBLE ELSE -0.733::DOUBLE END ELSE c0 END AS v0 FROM w0),
{steps},
wi AS (SELECT w3s.*, CASE WHEN w3 IS NULL OR val3 IS NOT NULL THEN v3 ELSE coalesce({said}, v3) + CASE WHEN w3 || ' ' || w2 IN ({pairs}) THEN -0.293::DOUBLE ELSE 0 END + CASE WHEN w2 || ' ' || w1 IN ({pairs}) THEN -0.293::DOUBLE ELSE 0 END END AS v4 FROM w3s),
wv AS (SELECT session_id, "index", CASE WHEN up <> 0 OR token = 'kind' AND n1 IS NOT DISTINCT FROM 'of' THEN 0 ELSE v4 * CASE WHEN w1 = 'least' AND val1 IS NULL AND coalesce(w2, '') NOT IN ('at', 'very') THEN -0.74::DOUBLE ELSE 1 END
  * CASE WHEN coalesce(but, 0) = 0 OR i = but THEN 1 WHEN i < but THEN 0.5::DOUBLE ELSE 1.5::DOUBLE END END AS v FROM wi),
su AS (SELECT session_id, "index", sum(v::DECIMAL(18, 6))::DOUBLE AS s FROM wv GROUP BY 1, 2),
am AS (SELECT ch.*, s + sign(s) * (least(length(body) - length(replace(body, '!', '')), 4) * 0.292 + CASE WHEN length(body) - length(replace(body, '?', '')) > 3 THEN 0.96 WHEN length(body) - length(replace(body, '?', '')) > 1 THEN (length(body) - length(replace(body, '?', ''))) * 0.18 ELSE 0 END) AS z FROM ch LEFT JOIN su USING (session_id, "index")),
sd AS (SELECT am.session_id, am."index", am.text, am.body, us.id64, '64:' || us.id64 AS player_key, us.name, us.is_bot, ix.date, round(coalesce(z, 0) / sqrt(coalesce(z, 0) * coalesce(z, 0) + 15), 4) AS compound FROM am JOIN us USING (session_id, uid) JOIN ix ON ix.id = am.session_id)
""".format(
    stop=STOP, boosters=", ".join(f"('{k}', {v}::DOUBLE)" for k, v in BOOSTERS.items()), phrases=", ".join(f"('{k}', {v}::DOUBLE)" for k, v in PHRASES.items()), neg=", ".join(f"'{w}'" for w in NEGATIONS), pairs=", ".join(f"'{w}'" for w in LOWERING_PAIRS),
    lags=", ".join(f"lag({c}, {j}) OVER z AS {a}{j}" for j in (1, 2, 3) for c, a in (("token", "w"), ("valence", "val"), ("up", "up"), ("neg", "neg"), ("loud", "loud"))),
    said="coalesce(" + ", ".join(f"(SELECT v FROM ph WHERE phrase = {e})" for e in ("token || ' ' || n1 || ' ' || n2", "token || ' ' || n1", "w1 || ' ' || token", "w2 || ' ' || w1 || ' ' || token", "w2 || ' ' || w1", "w3 || ' ' || w2 || ' ' || w1", "w3 || ' ' || w2")) + ")",
    steps=",\n".join(
        f"""m{j} AS (SELECT *, CASE WHEN up{j} = 0 THEN 0 ELSE sign(v{j - 1} + 1e-300) * up{j} + CASE WHEN mixed AND loud{j} THEN CASE WHEN v{j - 1} > 0 THEN 0.733::DOUBLE ELSE -0.733::DOUBLE END ELSE 0 END END * {damp}::DOUBLE AS by{j},
  CASE WHEN w{j} = 'never' AND {near.format("IN ('so', 'this')")} THEN 1.25::DOUBLE WHEN w{j} = 'without' AND {near.format("= 'doubt'")} THEN 1 WHEN neg{j} THEN -0.74::DOUBLE ELSE 1 END AS turn{j} FROM {prior}),
w{j}s AS (SELECT *, CASE WHEN w{j} IS NULL OR val{j} IS NOT NULL THEN v{j - 1} ELSE (v{j - 1} + by{j}) * turn{j} END AS v{j} FROM m{j})"""
        for j, damp, near, prior in ((1, 1.0, "'' {}", "wc"), (2, 0.95, "w1 {}", "w1s"), (3, 0.9, "(w2 {0} OR w1 {0})", "w2s"))
    ),
)
#: Common words of the conversations, and what stands for them where the rules are put to the test.
SWAPPED = {"the": "very", "of": "not", "and": "BUT", "to": "least", "in": "kind of", "a": "no", "de": "never", "is": "so", "that": "without", "der": "doubt", "for": "the bomb", "it": "yeah right", "was": "at least", "la": "BARELY", "on": "kiss of death", "as": "isn't"}
