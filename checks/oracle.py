"""SQL for DuckDB that answers the registered queries from the same tables.

Stateful steps are restated sequentially (recursive CTEs walk one window or one sighting
at a time), so they check the parallel plans against the plain definition.
"""

from __future__ import annotations

GLOBAL = "'all'"
TYPE = "event_type"


def r(x: str, d: int, name: str = "") -> str:
    scale = f"1e{d}"
    return f"(floor(({x}) * {scale} + 0.5) / {scale})" + (f" AS {name}" if name else "")


EV = """
raw AS (
  SELECT event_id, ts, epoch_us(ts) AS ts_us, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
),
ev AS (
  SELECT event_id AS seq, ts_us, event_type, 'events' AS source, CAST(event_id AS VARCHAR) AS id,
         CASE event_type WHEN 'signup' THEN 'new' WHEN 'purchase' THEN 'log'
                         WHEN 'error' THEN 'categorize' ELSE 'edit' END AS kind,
         CAST(user_id AS VARCHAR) AS actor, CAST(k AS VARCHAR) AS subject,
         user_id % 5 = 0 AS bot,
         CAST(floor(value) AS BIGINT) * CASE WHEN event_type = 'error' THEN -1 ELSE 1 END AS bytes_delta,
         'k' || (k % 10) || '.example.org' AS domain, 'k' || (k % 10) AS lang,
         CAST(k % 4 AS VARCHAR) AS namespace,
         CASE WHEN user_id % 5 = 0 THEN 'bot' ELSE 'human' END AS user_type
  FROM raw
)"""

COUNTERS = """count(*) AS count, count(DISTINCT nullif(subject, '')) AS distinct_subjects,
         count(DISTINCT nullif(actor, '')) AS distinct_actors,
         count(*) FILTER (bot) AS bot_count, count(*) FILTER (kind = 'new') AS new_count,
         CAST(sum(abs(bytes_delta)) AS BIGINT) AS bytes_changed"""
COUNT_NAMES = ("count", "distinct_subjects", "distinct_actors", "bot_count", "new_count", "bytes_changed")


def windows(series: str, tick: int, source: str = "ev", wid: str = "") -> str:
    wid = wid or f"CAST(floor(ts_us / {tick * 1_000_000}) AS BIGINT)"
    return f"""
w AS (
  SELECT {series} AS series, {wid} AS window_id, {COUNTERS} FROM {source} GROUP BY 1, 2
)"""


def window_view(rows: str, tick: int) -> str:
    return f"""
SELECT series, window_id, window_id * {tick}.0::DOUBLE AS window_start,
       window_id * {tick}.0::DOUBLE + {tick} AS window_end, {', '.join(COUNT_NAMES)},
       count / {tick}.0::DOUBLE AS rate,
       {r("CASE WHEN count > 0 THEN bot_count / count::DOUBLE ELSE 0.0::DOUBLE END", 6, "bot_ratio")},
       {r(f"bytes_changed / {tick}.0::DOUBLE", 6, "bytes_per_sec")},
       {r(f"new_count / {tick}.0::DOUBLE", 9, "new_rate")}
FROM {rows}"""


def dense(hi: str = "max(window_id)") -> str:
    zeros = ", ".join(f"coalesce(w.{c}, 0) AS {c}" for c in COUNT_NAMES)
    return f"""
b AS (SELECT series, min(window_id) AS lo, {hi} AS hi FROM w GROUP BY 1),
ids AS (SELECT series, lo, unnest(generate_series(lo, hi)) AS window_id FROM b),
dense AS (
  SELECT ids.series, ids.lo, ids.window_id, {zeros}
  FROM ids LEFT JOIN w ON w.series = ids.series AND w.window_id = ids.window_id
)"""


SNAP = "(CASE WHEN abs(x - mean) <= abs(x) * 1e-12 THEN 0.0::DOUBLE ELSE x - mean END)"


def ok(delta: str, direction: str) -> str:
    return {"up": f"({delta}) > 0", "down": f"({delta}) < 0", "both": "true"}[direction]


def verdict(prefix: str, delta: str, std: str, warm: str, thr: float, direction: str) -> str:
    z = f"abs(({delta}) / ({std}))"
    good = ok(delta, direction)
    return f"""
    CASE WHEN {warm} THEN false WHEN {std} < 1e-9 THEN abs({delta}) > 1e-9 AND {good}
         ELSE {good} AND {z} >= {thr} END AS {prefix}_flag,
    CASE WHEN {warm} THEN 0.0::DOUBLE
         WHEN {std} < 1e-9 THEN CASE WHEN abs({delta}) > 1e-9 AND {good} THEN 0.6::DOUBLE ELSE 0.0::DOUBLE END
         WHEN {good} THEN 1.0::DOUBLE / (1.0::DOUBLE + exp(-({z} - {thr}))) ELSE 0.0::DOUBLE END AS {prefix}_score"""


def zscore(x: str, thr: float = 3.2, direction: str = "up") -> str:
    return f"""
zh AS (
  SELECT series, lo, window_id, count, {x} AS x, count(*) OVER h AS n, avg({x}) OVER h AS mean,
         stddev_samp({x}) OVER h AS std
  FROM dense WINDOW h AS (PARTITION BY series ORDER BY window_id ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)
),
z AS (
  SELECT series, lo, window_id, count, x, n < 12 AS z_warm,
         CASE WHEN n < 12 THEN x ELSE mean END AS z_expected,
         {verdict("z", SNAP, "std", "n < 12", thr, direction)}
  FROM zh
)"""


def ewma(x: str, thr: float = 3.2, direction: str = "up", alpha: float = 0.08) -> str:
    """State after i values; value i+1 is judged against it."""
    return f"""
xs AS (SELECT series, list({x} ORDER BY window_id) AS xs, count(*) AS n, min(window_id) AS lo
       FROM dense GROUP BY series),
st(series, i, m, v) AS (
  SELECT series, 1::BIGINT, xs[1], 0.0::DOUBLE FROM xs
  UNION ALL
  SELECT st.series, i + 1, m + {alpha}::DOUBLE * (xs[i + 1] - m),
         (1.0::DOUBLE - {alpha}::DOUBLE) * (v + {alpha}::DOUBLE * (xs[i + 1] - m) * (xs[i + 1] - m))
  FROM st JOIN xs ON xs.series = st.series WHERE i < n
),
eh AS (
  SELECT d.series, d.window_id, {x} AS x, d.window_id - d.lo + 1 AS n, m AS mean, sqrt(v) AS std
  FROM dense d LEFT JOIN st ON st.series = d.series AND st.i = d.window_id - d.lo
),
e AS (
  SELECT series, window_id, x, n <= 12 AS e_warm, coalesce(mean, x) AS e_expected,
         {verdict("e", SNAP, "std", "n <= 12", thr, direction)}
  FROM eh
)"""


FEATURES7 = ("count / {t}::DOUBLE", "count::DOUBLE", "distinct_subjects::DOUBLE", "distinct_actors::DOUBLE",
             "CASE WHEN count > 0 THEN bot_count / count::DOUBLE ELSE 0.0::DOUBLE END",
             "bytes_changed / {t}::DOUBLE", "new_count / {t}::DOUBLE")


def hst(tick: int, trees: int = 25, height: int = 8, window: int = 120, seed: int = 7,
        warmup: int = 50, thr: float = 0.85) -> str:
    """Half-space trees: draw the trees, walk every window down every tree, score by block."""
    feats = [f.format(t=tick) for f in FEATURES7]
    running = "PARTITION BY series ORDER BY window_id ROWS UNBOUNDED PRECEDING"
    scaled = ", ".join(f"CASE WHEN h{i} > l{i} THEN (f{i} - l{i}) / (h{i} - l{i}) ELSE 0.0::DOUBLE END" for i in range(7))
    return f"""
dr(tree, i, x) AS (
  SELECT tree, 1, (1 + ({seed} * 7919 + tree * 104729 + 12345) % 2147483646) * 48271 % 2147483647
  FROM (SELECT unnest(range({trees})) AS tree)
  UNION ALL SELECT tree, i + 1, x * 48271 % 2147483647 FROM dr WHERE i < {7 + 2 ** height - 1}
),
us AS (SELECT tree, list(x / 2147483647.0::DOUBLE ORDER BY i) AS u FROM dr GROUP BY 1),
nd(tree, node, q, cut, lo, hi) AS (
  SELECT tree, node, q, (lo[q] + hi[q]) / 2, lo, hi FROM (
    SELECT tree, 1 AS node, CAST(floor(u[8] * 7) AS BIGINT) + 1 AS q,
           list_transform(u[1:7], lambda s: s - 2 * greatest(s, 1 - s)) AS lo,
           list_transform(u[1:7], lambda s: s + 2 * greatest(s, 1 - s)) AS hi FROM us)
  UNION ALL
  SELECT tree, node, q, (lo[q] + hi[q]) / 2, lo, hi FROM (
    SELECT nd.tree, 2 * nd.node + side AS node, CAST(floor(u[7 + 2 * nd.node + side] * 7) AS BIGINT) + 1 AS q,
           list_transform(range(1, 8), lambda i: CASE WHEN side = 1 AND i = nd.q THEN nd.cut ELSE nd.lo[i] END) AS lo,
           list_transform(range(1, 8), lambda i: CASE WHEN side = 0 AND i = nd.q THEN nd.cut ELSE nd.hi[i] END) AS hi
    FROM nd JOIN us ON us.tree = nd.tree CROSS JOIN (SELECT unnest([0, 1]) AS side) WHERE nd.node < {2 ** (height - 1)})
),
ft AS (SELECT series, window_id, window_id - lo AS rn, {", ".join(f"{f} AS f{i}" for i, f in enumerate(feats))} FROM dense),
fm AS (SELECT *, {", ".join(f"min(f{i}) OVER r AS l{i}, max(f{i}) OVER r AS h{i}" for i in range(7))}
       FROM ft WINDOW r AS ({running})),
fx AS (SELECT series, window_id, rn, rn // {window} AS blk, [{scaled}] AS x, f0 FROM fm),
pth(series, window_id, blk, tree, depth, node, x) AS (
  SELECT series, window_id, blk, tree, 0, 1, x FROM fx CROSS JOIN (SELECT unnest(range({trees})) AS tree)
  UNION ALL
  SELECT p.series, p.window_id, p.blk, p.tree, p.depth + 1,
         2 * p.node + CASE WHEN p.x[nd.q] >= nd.cut THEN 1 ELSE 0 END, p.x
  FROM pth p JOIN nd ON nd.tree = p.tree AND nd.node = p.node WHERE p.depth < {height}
),
ms AS (SELECT series, blk, tree, node, count(*) AS m FROM pth GROUP BY ALL),
pm AS (
  SELECT p.series, p.window_id, p.depth, coalesce(m, 0) AS m,
         min(coalesce(m, 0)) OVER (PARTITION BY p.series, p.window_id, p.tree ORDER BY p.depth
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above
  FROM pth p LEFT JOIN ms ON ms.series = p.series AND ms.blk = p.blk - 1 AND ms.tree = p.tree AND ms.node = p.node
  WHERE p.blk > 0
),
hs AS (SELECT series, window_id, 1.0::DOUBLE - sum(m * 2 ** depth) FILTER (above IS NULL OR above >= {0.1 * window})
              / ({trees} * {window} * {2 ** (height + 1) - 1})::DOUBLE AS raw FROM pm GROUP BY ALL),
h AS (
  SELECT fx.series, fx.window_id, f0 AS x, fx.rn + 1 > {warmup} AND coalesce(raw, 0.0) >= {thr} AS h_flag,
         CASE WHEN fx.rn + 1 > {warmup} THEN least(1.0::DOUBLE, greatest(0.0::DOUBLE, coalesce(raw, 0.0::DOUBLE))) ELSE 0.0::DOUBLE END AS h_score
  FROM fx LEFT JOIN hs ON hs.series = fx.series AND hs.window_id = fx.window_id
)"""


def ensemble3(tick: int) -> str:
    """All three detectors; the trees expect the value itself."""
    def fired(p: str, x: str) -> str:
        return f"CASE WHEN {p}_flag THEN {x} ELSE 0.0::DOUBLE END"

    total = " + ".join(fired(p, f"{p}_score") for p in "zeh")
    return f"""
s AS (
  SELECT z.series, z.window_id, z.x, z_flag, e_flag, h_flag,
         z_flag::INT + e_flag::INT + h_flag::INT AS agreement, {total} AS fired_sum,
         greatest({", ".join(fired(p, f"{p}_score") for p in "zeh")}) AS max_fired,
         {fired("z", "z_expected")} + {fired("e", "e_expected")} + {fired("h", "z.x")} AS exp_sum
  FROM z JOIN e ON z.series = e.series AND z.window_id = e.window_id
  JOIN h ON z.series = h.series AND z.window_id = h.window_id
),
c0 AS (SELECT *, least(1.0::DOUBLE, fired_sum / 3) AS conf, exp_sum / agreement AS expected FROM s WHERE agreement > 0),
c1 AS (
  SELECT *, CASE WHEN max_fired >= 0.92 AND agreement >= 2 THEN least(1.0::DOUBLE, conf + 0.05::DOUBLE)
                 ELSE conf END AS raw_score
  FROM c0 WHERE conf >= 0.5 OR max_fired >= 0.92
),
cand AS (
  SELECT series, window_id, window_id * {tick}.0::DOUBLE + {tick}.0::DOUBLE AS window_end, agreement,
         CASE WHEN raw_score >= 0.85 OR (agreement = 3 AND raw_score >= 0.65) THEN 'critical'
              WHEN raw_score >= 0.65 OR agreement = 3 THEN 'warn' ELSE 'info' END AS severity,
         {r("raw_score", 4, "score")}, x AS value, expected,
         row_number() OVER (PARTITION BY series ORDER BY window_id) AS rn
  FROM c1
)"""


def ensemble(tick: int) -> str:
    """Two live detectors."""
    return f"""
s AS (
  SELECT z.series, z.window_id, z.lo, z.count, z.x, z_flag, z_score, z_expected, e_flag, e_score, e_expected,
         z_flag::INT + e_flag::INT AS agreement,
         CASE WHEN z_flag THEN z_score ELSE 0.0::DOUBLE END + CASE WHEN e_flag THEN e_score ELSE 0.0::DOUBLE END AS fired_sum,
         greatest(CASE WHEN z_flag THEN z_score ELSE 0.0::DOUBLE END, CASE WHEN e_flag THEN e_score ELSE 0.0::DOUBLE END) AS max_fired
  FROM z JOIN e ON z.series = e.series AND z.window_id = e.window_id
),
c0 AS (
  SELECT *, least(1.0::DOUBLE, fired_sum / 2) AS conf,
         CASE WHEN z_flag AND e_flag THEN (z_expected + e_expected) / 2
              WHEN z_flag THEN z_expected ELSE e_expected END AS expected
  FROM s WHERE agreement > 0
),
c1 AS (
  SELECT *, CASE WHEN max_fired >= 0.92 AND agreement >= 2 THEN least(1.0::DOUBLE, conf + 0.05::DOUBLE)
                 ELSE conf END AS raw_score
  FROM c0 WHERE conf >= 0.5 OR max_fired >= 0.92
),
cand AS (
  SELECT series, window_id, window_id * {tick}.0::DOUBLE + {tick}.0::DOUBLE AS window_end, agreement,
         CASE WHEN raw_score >= 0.85 OR (agreement = 2 AND raw_score >= 0.65) THEN 'critical'
              WHEN raw_score >= 0.65 OR agreement = 2 THEN 'warn' ELSE 'info' END AS severity,
         {r("raw_score", 4, "score")}, x AS value, expected, z_flag, e_flag,
         row_number() OVER (PARTITION BY series ORDER BY window_id) AS rn
  FROM c1
)"""


def cooldown(seconds: float) -> str:
    return f"""
walk(series, rn, last, kept) AS (
  SELECT series, rn, window_end, true FROM cand WHERE rn = 1
  UNION ALL
  SELECT c.series, c.rn, CASE WHEN c.window_end - last < {seconds} THEN last ELSE c.window_end END,
         c.window_end - last >= {seconds}
  FROM walk JOIN cand c ON c.series = walk.series AND c.rn = walk.rn + 1
),
surf AS (
  SELECT cand.*, window_end AS ts,
         substr(sha256(cand.series || '|rate|' || CAST(window_id AS VARCHAR)), 1, 12) AS id
  FROM cand JOIN walk ON walk.series = cand.series AND walk.rn = cand.rn WHERE kept
)"""


def detect(series: str, tick: int, cd: float, thr: float = 3.2) -> str:
    x = f"(count / {tick}.0::DOUBLE)"
    return ", ".join((EV, windows(series, tick), dense(), zscore(x, thr), ewma(x, thr),
                      ensemble(tick), cooldown(cd)))


def scores(series: str, tick: int) -> str:
    x = f"(count / {tick}.0::DOUBLE)"
    return ", ".join((EV, windows(series, tick), dense(), zscore(x), ewma(x), ensemble(tick)))


CAND_VIEW = ("series, window_id, window_end, agreement, severity, score, "
             + r("value", 9, "value") + ", " + r("expected", 9, "expected"))

DIMS = ("domain", "lang", "kind", "namespace", "user_type")


def sightings(series: str, tick: int, k: int = 15) -> str:
    wid = f"CAST(floor(ts_us / {tick * 1_000_000}) AS BIGINT)"
    parts = " UNION ALL ".join(
        f"SELECT {series} AS series, {wid} AS window_id, '{d}' AS dim, {pos} AS pos, {d} AS value, seq FROM ev"
        for pos, d in enumerate(DIMS, 1)
    )
    return f"""
dc AS (
  SELECT series, window_id, dim, pos, value, count(*) AS cnt, min(seq) AS first_seq
  FROM ({parts}) WHERE value <> '' GROUP BY ALL
),
tk AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY series, window_id, dim ORDER BY cnt DESC, first_seq, value) AS rk
    FROM dc) WHERE rk <= {k}
)"""


BASE = """
sg AS (
  SELECT series, dim, value, list(window_id ORDER BY window_id) AS ws, list(cnt ORDER BY window_id) AS cs,
         count(*) AS n
  FROM tk GROUP BY ALL
),
bl(series, dim, value, i, pre, b) AS (
  SELECT series, dim, value, 1::BIGINT, 0.0::DOUBLE, 0.05::DOUBLE * cs[1] FROM sg
  UNION ALL
  SELECT series, dim, value, i, pre, 0.95::DOUBLE * pre + 0.05::DOUBLE * c FROM (
    SELECT bl.series, bl.dim, bl.value, i + 1 AS i, cs[i + 1] AS c,
           CASE WHEN ws[i + 1] - ws[i] = 1 THEN b
                WHEN b * pow(0.95::DOUBLE, ws[i + 1] - ws[i] - 1) < 0.05 THEN 0.0::DOUBLE
                ELSE b * pow(0.95::DOUBLE, ws[i + 1] - ws[i] - 1) END AS pre
    FROM bl JOIN sg ON sg.series = bl.series AND sg.dim = bl.dim AND sg.value = bl.value WHERE i < n)
),
lv AS (
  SELECT tk.*, pre AS baseline
  FROM (SELECT *, row_number() OVER (PARTITION BY series, dim, value ORDER BY window_id) AS i FROM tk) tk
  JOIN bl ON bl.series = tk.series AND bl.dim = tk.dim AND bl.value = tk.value AND bl.i = tk.i
)"""

WHY = f"""
ex AS (
  SELECT series, window_id, dim, pos, value, rk, cnt, {r("baseline", 2, "baseline")},
         {r("cnt - baseline", 2, "excess")}
  FROM lv SEMI JOIN surf ON surf.series = lv.series AND surf.window_id = lv.window_id
  WHERE cnt - baseline >= 1.0
),
sh AS (
  SELECT *, {r("excess / CAST(sum(CAST(excess AS DECIMAL(28,2))) OVER (PARTITION BY series, window_id, dim) AS DOUBLE)", 4, "share")},
         row_number() OVER (PARTITION BY series, window_id ORDER BY excess DESC, pos, rk) AS rank
  FROM ex
),
why AS (
  SELECT series, window_id, rank, dim, value, cnt AS observed, baseline, excess, share FROM sh WHERE rank <= 6
)"""


def flat(source: str = "ev") -> str:
    return f"""SELECT ts_us, source, id, kind, actor, subject, bot, bytes_delta,
       abs(bytes_delta)::DOUBLE AS weight, domain, lang, namespace, user_type FROM {source}"""


HOUR_WHY = detect(TYPE, 3600, 14_400.0) + ", " + sightings(TYPE, 3600) + ", " + BASE + ", " + WHY
BY_TYPE_SURF = f"WITH RECURSIVE {detect(TYPE, 3600, 14_400.0)}"
GLOBAL_SURF = f"WITH RECURSIVE {detect(GLOBAL, 600, 2_400.0)}"
BY_TYPE_SCORES = f"WITH RECURSIVE {scores(TYPE, 3600)}"
W600 = f"WITH {EV}, {windows(GLOBAL, 600)}"
W3600 = f"WITH {EV}, {windows(TYPE, 3600)}"
D600 = f"{W600}, {dense()}"
D3600 = f"{W3600}, {dense()}"


def one_detector(prefix: str, body: str, series: str, tick: int) -> str:
    return f"""WITH RECURSIVE {EV}, {windows(series, tick)}, {dense()}, {body}
SELECT series, window_id, {prefix}_flag AS flag, {r(f"{prefix}_score", 6, "score")}, {r("x", 9, "value")},
       {r(f"{prefix}_expected", 9, "expected")}, {prefix}_warm AS warmup FROM {prefix}"""


CHANGES = """
WITH raw AS (
  SELECT event_id AS e, epoch_us(ts) AS ts_us, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
p AS (
  SELECT *, CASE WHEN e % 3 = 0 THEN 'd' ELSE 's' END || (k % 10) || '.example.org' AS domain,
         CASE WHEN e % 17 = 0 THEN 1700000000 ELSE CAST(floor(ts_us / 1000000) AS BIGINT) END AS t,
         CASE WHEN e % 5 = 0 THEN 'edit' ELSE event_type END AS kind
  FROM raw WHERE e % 13 NOT IN (0, 1)
)
SELECT t * 1000000 AS ts_us, 'recentchange' AS source,
       CASE WHEN e % 7 = 0 THEN domain || '-' || t || '.0' ELSE 'm' || e END AS id,
       kind, CASE WHEN e % 11 = 0 THEN '?' ELSE CAST(user_id AS VARCHAR) END AS actor,
       't' || k AS subject, user_id % 5 = 0 AS bot, d AS bytes_delta, abs(d)::DOUBLE AS weight,
       domain, split_part(domain, '.', 1) AS lang,
       CASE WHEN e % 23 = 0 THEN '?' WHEN e % 19 = 0 THEN 'None' ELSE CAST(k % 4 AS VARCHAR) END AS namespace,
       CASE WHEN user_id % 5 = 0 THEN 'bot' ELSE 'human' END AS user_type
FROM (SELECT *, CASE WHEN e % 29 = 0 THEN 0
                     ELSE CAST(trunc(value) AS BIGINT) - CASE WHEN e % 2 = 0 THEN 0 ELSE k END END AS d FROM p)
"""


def fixed(x: str, d: int) -> str:
    return f"CAST(CAST(CAST({x} AS DECIMAL(38,{d + 8})) AS DECIMAL(30,{d})) AS VARCHAR)"


def compact(x: str) -> str:
    return f"""CASE WHEN abs({x}) >= 1000000 THEN {fixed(f"({x}) / 1000000", 1)} || 'M'
      WHEN abs({x}) >= 1000 THEN {fixed(f"({x}) / 1000", 1)} || 'k'
      WHEN abs({x}) >= 10 THEN {fixed(x, 0)} ELSE {fixed(x, 1)} END"""


FACTOR = "(CASE WHEN expected > 0 THEN value / expected ELSE 0.0::DOUBLE END)"

WORDS = r"""list_filter(string_split(regexp_replace(lower(text), '[^\p{L}\p{N}_]+', ' ', 'g'), ' '), lambda x: length(x) >= 3)"""

BM25 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS words FROM documents),
n AS (SELECT count(*)::DOUBLE AS n, avg(len(words)) AS avg_len FROM d),
q AS (SELECT item_id AS query_id, unnest({WORDS}) AS term FROM benchmark),
qt AS (SELECT query_id, term, count(*) AS weight FROM q GROUP BY ALL),
tf AS (SELECT doc_id, dl, term, count(*) AS tf FROM (SELECT doc_id, len(words) AS dl, unnest(words) AS term FROM d)
       WHERE term IN (SELECT term FROM qt) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
sc AS (
  SELECT query_id, doc_id, round(sum(weight * ln((n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE) + 1.0::DOUBLE) * tf * 2.5::DOUBLE
         / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avg_len))), 9) AS score
  FROM tf JOIN qt USING (term) JOIN df USING (term), n GROUP BY ALL
)
SELECT query_id, doc_id, score, rank::INT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0)
WHERE rank <= 5
"""


def category_sql() -> str:
    from surgemark.operators.text import CATEGORY_KEYWORDS, DEFAULT_CATEGORY

    hits = ", ".join(
        "(" + " + ".join(f"contains(low, '{k}')::INT" for k in words) + ")"
        for words in CATEGORY_KEYWORDS.values()
    )
    names = ", ".join(f"'{c}'" for c in CATEGORY_KEYWORDS)
    return f"""
WITH h AS (SELECT doc_id, [{hits}] AS h FROM (SELECT doc_id, lower(text) AS low FROM documents))
SELECT doc_id, list_max(h) AS hits,
       CASE WHEN list_max(h) > 0 THEN [{names}][list_position(h, list_max(h))] ELSE '{DEFAULT_CATEGORY}' END AS category
FROM h"""


ORACLE: dict[str, str] = {
    "normalise_events": f"WITH {EV} {flat()}",
    "jsonl_replay": f"WITH {EV} {flat()}",
    "normalise_orders": """
SELECT epoch_us(o_orderdate) AS ts_us, 'orders' AS source, CAST(o_orderkey AS VARCHAR) AS id,
       o_orderstatus AS kind, CAST(o_custkey AS VARCHAR) AS actor, CAST(o_orderkey AS VARCHAR) AS subject,
       false AS bot, CAST(floor(o_totalprice) AS BIGINT) AS bytes_delta,
       abs(floor(o_totalprice))::DOUBLE AS weight, o_orderpriority AS domain FROM orders""",
    "recentchange_normalise": CHANGES,
    "sse_capture": """
SELECT CAST(last_value(CASE WHEN event_id % 3 <> 0 THEN event_id END IGNORE NULLS)
              OVER (PARTITION BY event_id // 2000 ORDER BY event_id) AS VARCHAR) AS event_id,
       CAST(event_id AS VARCHAR) || chr(10) || event_type AS data
FROM events QUALIFY event_id % 10 <> 9""",
    "registered_changes": f"""
SELECT name, kind, namespace, count(*) AS n, CAST(sum(bytes_delta) AS BIGINT) AS bytes, count(*) FILTER (bot) AS bots,
       count(DISTINCT subject) AS subjects
FROM ({CHANGES}) CROSS JOIN (VALUES ('recentchange'), ('capture')) AS t(name) GROUP BY name, kind, namespace""",
    "dedupe": f"WITH {EV} SELECT source, id, kind, bytes_delta FROM ev",
    "rate_cap": f"""WITH {EV} SELECT seq, kind FROM ev
QUALIFY row_number() OVER (PARTITION BY seq // 5 ORDER BY seq) <= 3""",
    "rate_drops": f"""WITH {EV} SELECT seq // 5 AS second, count(*) - 3 AS dropped FROM ev
GROUP BY 1 HAVING count(*) > 3""",
    "retime": f"""WITH {EV} SELECT seq, {r("round((1800000000.0::DOUBLE + (ts_us / 1e6 - arg_min(ts_us / 1e6, seq) OVER ()) / 4.0::DOUBLE) * 1e6) / 1e6", 3, "t")} FROM ev""",
    "replay_gaps": f"""WITH {EV} SELECT seq, {r("coalesce(least(greatest(0.0::DOUBLE, ts_us / 1e6 - lag(ts_us / 1e6) OVER (ORDER BY seq)) / 100.0::DOUBLE, 5.0::DOUBLE), 0.0::DOUBLE)", 6, "gap")} FROM ev""",
    "window_metrics": W600 + window_view("w", 600),
    "window_metrics_by_type": W3600 + window_view("w", 3600),
    "orders_windows": f"""
WITH o AS (SELECT epoch_us(o_orderdate) AS ts_us, o_orderstatus AS kind, CAST(o_custkey AS VARCHAR) AS actor,
           CAST(o_orderkey AS VARCHAR) AS subject, false AS bot, CAST(floor(o_totalprice) AS BIGINT) AS bytes_delta
           FROM orders), {windows(GLOBAL, 86_400, "o")}""" + window_view("w", 86_400),
    "window_metrics_gapfilled": D600 + window_view("dense", 600),
    "flush_windows": f"{W3600}, {dense('greatest(max(window_id), 1706749200 // 3600) - 1')}"
                     + window_view("dense", 3600),
    "fold_late_windows": f"""WITH {EV},
late AS (SELECT ev.*, max(CAST(floor(ts_us / 600000000) AS BIGINT)) OVER (
           ORDER BY seq + 37 * (seq % 11) ROWS UNBOUNDED PRECEDING) AS wid FROM ev),
{windows(GLOBAL, 600, "late", "wid")}""" + window_view("w", 600),
    "feature_vector": f"""{W600}
SELECT window_id, name, {r("v", 6, "v")} FROM (
  SELECT window_id, unnest(['rate','count','distinct_subjects','distinct_actors','bot_ratio','bytes_per_sec','new_rate']) AS name,
         unnest([count / 600::DOUBLE, count::DOUBLE, distinct_subjects::DOUBLE, distinct_actors::DOUBLE,
                 bot_count / count::DOUBLE, bytes_changed / 600::DOUBLE, new_count / 600::DOUBLE]) AS v FROM w)""",
    "dim_counts": f"WITH {EV}, {sightings(GLOBAL, 3600)} SELECT series, window_id, dim, value, cnt FROM dc",
    "dim_topk": f"WITH {EV}, {sightings(GLOBAL, 3600, 3)} SELECT series, window_id, dim, value, cnt, rk::INT AS rk FROM tk",
    "zscore": one_detector("z", zscore("(count / 600.0::DOUBLE)"), GLOBAL, 600),
    "zscore_both": one_detector("z", zscore("(bytes_changed / 3600.0::DOUBLE)", direction="both"), TYPE, 3600),
    "ewma": one_detector("e", ewma("(count / 600.0::DOUBLE)"), GLOBAL, 600),
    "registered_detector": f"""{D600}
SELECT series, window_id, count > 18 AS flag, CASE WHEN count > 18 THEN 1.0 ELSE 0.0 END::DOUBLE AS score,
       count::DOUBLE AS value, 18.0::DOUBLE AS expected FROM dense""",
    "source_registry": f"""WITH {EV},
o AS (SELECT epoch_us(o_orderdate) AS ts_us, CAST(floor(o_totalprice) AS BIGINT) AS b FROM orders)
SELECT name, count(*) AS n, sum(bytes_delta)::BIGINT AS bytes, count(*) FILTER (bot) AS bots, min(ts_us) AS first_us
FROM ev, (VALUES ('events'), ('jsonl')) v(name) GROUP BY 1
UNION ALL SELECT 'orders', count(*), sum(b)::BIGINT, 0, min(ts_us) FROM o""",
    "ewma_fast": one_detector("e", ewma("(count / 600.0::DOUBLE)", alpha=0.96), GLOBAL, 600),
    "ewma_long_history": one_detector("e", ewma("(count / 300.0::DOUBLE)"), GLOBAL, 300),
    "ewma_down": one_detector("e", ewma("(count / 3600.0::DOUBLE)", direction="down"), TYPE, 3600),
    "hst": f"""WITH RECURSIVE {EV}, {windows(GLOBAL, 3600)}, {dense()}, {hst(3600)}
SELECT series, window_id, h_flag AS flag, {r("h_score", 6, "score")}, {r("x", 9, "value")} FROM h""",
    "anomalies_three_detectors": f"""WITH RECURSIVE {EV}, {windows(GLOBAL, 600)}, {dense()},
{zscore("(count / 600.0::DOUBLE)")}, {ewma("(count / 600.0::DOUBLE)")}, {hst(600)}, {ensemble3(600)},
{cooldown(2_400.0)}, {sightings(GLOBAL, 600)}, {BASE}, {WHY},
n AS (SELECT series, window_id, count(*) AS n_why FROM why GROUP BY ALL)
SELECT id, ts, surf.series, 'rate' AS metric, severity, score, agreement, 3::INT AS n_detectors,
       coalesce(n_why, 0)::INT AS n_why
FROM surf LEFT JOIN n ON n.series = surf.series AND n.window_id = surf.window_id""",
    "detector_results": f"""{BY_TYPE_SCORES}
SELECT series, window_id, 'zscore' AS name, z_flag AS flag, {r("z_score", 6, "score")}, false AS unavailable FROM s
UNION ALL SELECT series, window_id, 'ewma', e_flag, {r("e_score", 6)}, false FROM s
UNION ALL SELECT series, window_id, 'hst', false, 0.0::DOUBLE, true FROM s""",
    "ensemble_candidates": f"WITH RECURSIVE {scores(GLOBAL, 600)} SELECT {CAND_VIEW} FROM cand",
    "cooldown": f"WITH RECURSIVE {detect(TYPE, 3600, 90_000.0, 1.5)} SELECT {CAND_VIEW} FROM surf",
    "anomalies": f"{GLOBAL_SURF} SELECT {CAND_VIEW}, id, ts FROM surf",
    "baseline": f"""WITH RECURSIVE {EV}, {sightings(TYPE, 3600)}, {BASE}
SELECT series, window_id, dim, value, cnt, {r("baseline", 6, "baseline")} FROM lv""",
    "why": f"WITH RECURSIVE {HOUR_WHY} SELECT * REPLACE (rank::INT AS rank) FROM why",
    "anomalies_explained": f"""WITH RECURSIVE {HOUR_WHY},
n AS (SELECT series, window_id, count(*)::INT AS n_why FROM why GROUP BY ALL)
SELECT id, surf.series, surf.window_id, ts, 'rate' AS metric, severity, score, agreement,
       {r("surf.value", 9, "value")}, {r("expected", 9, "expected")}, coalesce(n_why, 0)::INT AS n_why,
       dim AS top_dim, why.value AS top_value, excess AS top_excess, share AS top_share
FROM surf LEFT JOIN n ON n.series = surf.series AND n.window_id = surf.window_id
LEFT JOIN why ON why.series = surf.series AND why.window_id = surf.window_id AND rank = 1""",
    "anomaly_frame": f"{BY_TYPE_SURF} SELECT 'anomaly' AS type, id, severity, agreement FROM surf",
    "incident_window": f"""{GLOBAL_SURF}
SELECT id AS anomaly_id, ts AS anomaly_ts, d.window_id, d.count, d.count / 600.0::DOUBLE AS rate
FROM surf JOIN dense d ON d.window_id * 600.0 + 600.0 BETWEEN ts - 3600 AND ts + 3600""",
    "recent_metrics": f"""{D600}
SELECT window_id, window_id * 600.0::DOUBLE + 600 AS window_end, count, count / 600.0::DOUBLE AS rate FROM dense
WHERE window_id * 600 >= (SELECT max(window_id) * 600 - 86400 FROM dense)""",
    "stored_recent_metrics": f"""{D600},
sc AS (SELECT ts_us // 600000000 AS window_id, domain, count(*) AS cnt, min(seq) AS s FROM ev GROUP BY 1, 2),
td AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY window_id ORDER BY cnt DESC, s) = 1)
SELECT window_id * 600.0::DOUBLE + 600 AS window_end, count, count / 600.0::DOUBLE AS rate, domain AS top_domain, cnt AS top_cnt
FROM dense LEFT JOIN td USING (window_id) WHERE window_id * 600 >= (SELECT max(window_id) * 600 - 86400 FROM dense)""",
    "stored_incident": f"""{GLOBAL_SURF},
m AS (SELECT window_id * 600.0::DOUBLE + 600 AS window_end, count FROM dense
      WHERE window_id * 600 >= (SELECT max(window_id) * 600 - 7 * 86400 FROM dense))
SELECT id AS anomaly_id, ts AS anomaly_ts, severity AS anomaly_severity, m.window_end, m.count
FROM surf LEFT JOIN m ON m.window_end BETWEEN ts - 3600 AND ts + 3600""",
    "stored_incident_one": f"""{GLOBAL_SURF},
m AS (SELECT window_id * 600.0::DOUBLE + 600 AS window_end, count FROM dense
      WHERE window_id * 600 >= (SELECT max(window_id) * 600 - 7 * 86400 FROM dense))
SELECT id AS anomaly_id, ts AS anomaly_ts, severity AS anomaly_severity, m.window_end, m.count
FROM surf LEFT JOIN m ON m.window_end BETWEEN ts - 3600 AND ts + 3600 WHERE id = (SELECT max(id) FROM surf)""",
    "stored_snapshot": f"""{GLOBAL_SURF},
m AS (SELECT window_id * 600.0::DOUBLE + 600 AS t, count FROM dense
      WHERE window_id * 600 >= (SELECT max(window_id) * 600 - 7 * 86400 FROM dense) ORDER BY t DESC LIMIT 900),
a AS (SELECT ts AS t, id FROM surf ORDER BY ts DESC, id LIMIT 200)
SELECT 'metric' AS kind, (row_number() OVER (ORDER BY t) - 1)::INT AS pos, t, count, NULL::VARCHAR AS id FROM m
UNION ALL SELECT 'anomaly', (row_number() OVER (ORDER BY t DESC) - 1)::INT, t, NULL, id FROM a""",
    "append_idempotent": f"{GLOBAL_SURF} SELECT id, ts, series, severity, agreement FROM surf",
    "recent_metrics_as_of": f"""{D600}
SELECT window_id, window_id * 600.0::DOUBLE + 600 AS window_end, count, count / 600.0::DOUBLE AS rate FROM dense
WHERE window_id * 600 + 600 > 1705000200 - 7200""",
    "recent_anomalies": f"{BY_TYPE_SURF} SELECT id, ts, series, severity, score FROM surf ORDER BY ts DESC, id LIMIT 10",
    "anomaly_listing": f"{BY_TYPE_SURF} SELECT id, ts, series, severity FROM surf ORDER BY ts DESC, id LIMIT 200",
    "last_windows": f"""{W3600} SELECT series, window_id, count FROM w
QUALIFY row_number() OVER (PARTITION BY series ORDER BY window_id DESC) <= 20""",
    "snapshot": f"""{BY_TYPE_SURF}
SELECT (SELECT least(count(*), 900)::INT FROM dense) AS n_metrics, (SELECT least(count(*), 200)::INT FROM surf) AS n_anomalies,
       (SELECT max(window_id) * 3600.0::DOUBLE + 3600 FROM dense) AS last_end, 3600.0::DOUBLE AS tick_seconds""",
    "retention": f"""{W600}
SELECT (window_id + 1) * 600000000 AS t_us, series, count, {r("count / 600.0::DOUBLE", 9, "rate")} FROM w
WHERE (window_id + 1) * 600 >= (SELECT (max(window_id) + 1) * 600 - 7 * 86400 FROM w)""",
    "expired_days": f"""{W600}, t AS (SELECT series, (window_id + 1) * 600 AS s, count FROM w)
SELECT series, s::DOUBLE AS window_end, count FROM t WHERE s // 86400 >= (SELECT max(s) // 86400 - 7 FROM t)""",
    "idempotent_append": f"{W3600} SELECT series, window_id, count FROM w",
    "pipeline_stats": f"""{GLOBAL_SURF}
SELECT (SELECT count(*) FROM events) AS events_seen, (SELECT count(*) FROM dense) AS snapshots,
       (SELECT count(*) FROM surf) AS anomalies,
       (SELECT {r("arg_max(count, window_id) / 600.0::DOUBLE", 3)} FROM dense) AS last_rate, 2::INT AS detectors""",
    "trend": f"""{D3600},
t AS (SELECT series, window_id, count, lag(count, 30) OVER (PARTITION BY series ORDER BY window_id) AS past FROM dense),
u AS (SELECT series, window_id, CASE WHEN past <> 0 THEN (count - past) / past::DOUBLE END AS t FROM t)
SELECT series, window_id, {r("t", 6, "trend")},
       CASE WHEN t > 0.02 THEN 'up' WHEN t < -0.02 THEN 'down' WHEN t IS NOT NULL THEN 'flat' END AS direction FROM u""",
    "agreement": f"""{BY_TYPE_SCORES} SELECT series, window_id, agreement, 2::INT AS available FROM s
QUALIFY row_number() OVER (PARTITION BY series ORDER BY window_id DESC) <= 48""",
    "detector_scores": f"""{BY_TYPE_SCORES}
SELECT series, window_id, {r("z_score", 6, "zscore")}, {r("e_score", 6, "ewma")} FROM s
QUALIFY row_number() OVER (PARTITION BY series ORDER BY window_id DESC) <= 60""",
    "sparkline": f"""{D3600},
l AS (SELECT series, window_id, count AS v FROM dense
      QUALIFY row_number() OVER (PARTITION BY series ORDER BY window_id DESC) <= 60),
m AS (SELECT *, count(*) OVER p AS n, min(v) OVER p AS lo, max(v) OVER p - min(v) OVER p AS span,
             row_number() OVER (PARTITION BY series ORDER BY window_id) - 1 AS i FROM l WINDOW p AS (PARTITION BY series))
SELECT series, window_id, {r("i * (100.0::DOUBLE / (n - 1))", 6, "x")},
       {r("100.0::DOUBLE - (v - lo) / (CASE WHEN span = 0 THEN 1 ELSE span END)::DOUBLE * 100.0", 6, "y")} FROM m WHERE n >= 2""",
    "series_summary": f"""{W3600},
b AS (SELECT series, max(count) AS peak, sum(count)::BIGINT AS total_events, max(window_id) * 3600.0::DOUBLE + 3600 AS x_max FROM w GROUP BY 1)
SELECT b.series, {r("any_value(peak) / 3600.0::DOUBLE", 9, "peak_rate")}, any_value(total_events) AS total_events,
       any_value(x_max) - 86400 AS x_min, any_value(x_max) AS x_max,
       {r("greatest(5.0::DOUBLE, max(w.count) / 3600.0::DOUBLE * 1.15::DOUBLE)", 6, "y_max")}
FROM b JOIN w ON w.series = b.series AND w.window_id * 3600 + 3600 >= x_max - 86400 GROUP BY b.series""",
    "chart_markers": f"""{BY_TYPE_SURF}
SELECT id, surf.series, ts FROM surf JOIN (SELECT series, max(window_id) * 3600.0 + 3600 AS x FROM w GROUP BY 1) m
ON m.series = surf.series AND ts BETWEEN x - 15 * 86400 AND x""",
    "stale_intervals": f"""WITH {EV},
g AS (SELECT event_type AS series, ts_us / 1e6 AS t, lead(ts_us / 1e6) OVER (PARTITION BY event_type ORDER BY ts_us) AS nxt FROM ev)
SELECT series, {r("t", 3, "silent_from")}, {r("nxt", 3, "silent_to")}, {r("nxt - t", 3, "silent_seconds")}
FROM g WHERE nxt - t > 600""",
    "health_latest_rate": f"""{W3600}
SELECT series, {r("arg_max(count, window_id) / 3600.0::DOUBLE", 9, "latest_rate")} FROM w GROUP BY 1""",
    "health_anomalies_trailing": f"""{BY_TYPE_SURF},
g AS (SELECT series, ts::BIGINT AS second, count(*) AS n FROM surf GROUP BY ALL)
SELECT series, second, n, (sum(n) OVER (PARTITION BY series ORDER BY second RANGE BETWEEN 200000 PRECEDING AND CURRENT ROW))::BIGINT AS trailing FROM g""",
    "health_drops_trailing": f"""WITH {EV},
d AS (SELECT ts_us // 600000000 AS second, count(*) AS c FROM ev GROUP BY 1 HAVING count(*) > 1)
SELECT 'all' AS series, second, (c - 1)::BIGINT AS n,
       (sum(c - 1) OVER (ORDER BY second RANGE BETWEEN 30 PRECEDING AND CURRENT ROW))::BIGINT AS trailing FROM d""",
    "health_lag": f"""{W600}
SELECT series, window_id, greatest(0.0::DOUBLE, count - 1.0::DOUBLE) AS lag,
       CASE WHEN count - 1 >= 5 THEN 'red' WHEN count - 1 >= 2 THEN 'yellow' ELSE 'green' END AS band FROM w""",
    "health_throughput": f"""WITH {EV}
SELECT event_type AS series, ts_us // 60000000 * 60 AS minute, {r("count(*) / 60.0::DOUBLE", 6, "ingested_per_sec")},
       {r("count(*) FILTER (NOT bot) / 60.0::DOUBLE", 6, "processed_per_sec")} FROM ev GROUP BY 1, 2""",
    "health_anomalies_by_severity": f"""{BY_TYPE_SURF}
SELECT (ts // 60 * 60)::BIGINT AS minute, severity, count(*) AS n FROM surf GROUP BY 1, 2""",
    "health_detector_fires": f"""{BY_TYPE_SCORES},
f AS (SELECT window_id, 'zscore' AS name FROM s WHERE z_flag UNION ALL SELECT window_id, 'ewma' FROM s WHERE e_flag)
SELECT (window_id + 1) * 3600 AS minute, name, count(*) AS n FROM f GROUP BY 1, 2""",
    "health_duration_p95": f"""WITH {EV}
SELECT (ts_us // 288000000) // 300 * 300 AS period, count(*) AS batches,
       quantile_disc(bytes_delta::DOUBLE, 0.95) AS p95 FROM ev GROUP BY 1""",
    "metric_frame": f"""{BY_TYPE_SCORES}
SELECT 'metric' AS type, dense.series, (dense.window_id + 1) * 3600.0::DOUBLE AS t, dense.window_id * 3600.0::DOUBLE AS ws,
       {r("dense.count / 3600.0::DOUBLE", 3, "rate")}, dense.count, distinct_subjects, distinct_actors,
       {r("CASE WHEN dense.count > 0 THEN bot_count / dense.count::DOUBLE ELSE 0.0::DOUBLE END", 4, "bot_ratio")},
       {r("bytes_changed / 3600.0::DOUBLE", 1, "bytes_per_sec")}, {r("new_count / 3600.0::DOUBLE", 3, "new_rate")},
       {r("z_score", 4, "z_score")}, z_flag, true AS z_available
FROM dense JOIN z ON z.series = dense.series AND z.window_id = dense.window_id""",
    "metric_frame_top": f"""WITH {EV}, {sightings(GLOBAL, 3600)}
SELECT (window_id + 1) * 3600.0::DOUBLE AS t, dim, (rk - 1)::INT AS pos, value, cnt FROM tk
WHERE dim IN ('domain', 'lang') AND rk <= 6""",
    "anomaly_report": f"""{BY_TYPE_SURF}
SELECT id, CASE severity WHEN 'critical' THEN 'CRITICAL' WHEN 'warn' THEN 'WARNING' ELSE 'INFO' END AS label,
       'rate spike' AS title, {compact("value")} AS observed, {compact("expected")} AS expected,
       CASE WHEN {FACTOR} >= 10 THEN ({compact(FACTOR)}) || '×'
            WHEN {FACTOR} > 1.2 THEN {fixed(FACTOR, 1)} || '×' END AS factor,
       {fixed("score * 100", 0)} || '%' AS confidence, agreement || '/2 agree' AS agree, '1h ago' AS age,
       CASE WHEN z_flag AND e_flag THEN 'zscore,ewma' WHEN z_flag THEN 'zscore' ELSE 'ewma' END AS fired
FROM surf""",
    "anomaly_cards": f"""WITH RECURSIVE {HOUR_WHY}
SELECT id, rank::INT AS rank, CASE dim WHEN 'domain' THEN 'wiki' WHEN 'lang' THEN 'language' WHEN 'kind' THEN 'type'
       WHEN 'user_type' THEN 'actor' ELSE dim END || ': ' || why.value AS label,
       {r("least(100.0::DOUBLE, share * 100)", 6, "width_pct")}, '+' || ({compact("excess")}) AS excess
FROM surf JOIN why ON why.series = surf.series AND why.window_id = surf.window_id WHERE rank <= 4""",
    "tiles": f"""{W3600},
m AS (SELECT series, max(window_id) AS window_id FROM w GROUP BY 1)
SELECT w.series, {compact("(count / 3600.0::DOUBLE)")} AS events_per_sec,
       CAST(distinct_subjects AS VARCHAR) AS active_subjects, CAST(distinct_actors AS VARCHAR) AS active_actors,
       {fixed("bot_count / count::DOUBLE * 100", 0)} || '%' AS bot_share
FROM w JOIN m ON m.series = w.series AND m.window_id = w.window_id""",
    "stream_windows": f"""{W3600}, {sightings(TYPE, 3600)[1:]},
t AS (SELECT series, window_id, count(*)::INT AS n_dims, arg_min(value, pos * 100 + rk) AS top_domain,
             arg_min(cnt, pos * 100 + rk) AS top_cnt FROM tk GROUP BY ALL)
SELECT w.*, n_dims, top_domain, top_cnt FROM w
JOIN t ON t.series = w.series AND t.window_id = w.window_id
WHERE (w.window_id + 1) * 3600000 <= (SELECT max(ts_us) // 1000 FROM ev)""",
    "stream_fold": f"""WITH {EV},
late AS (SELECT ev.*, max(CAST(floor(ts_us / 600000000) AS BIGINT)) OVER (
           ORDER BY (seq + 37 * (seq % 11)) * 11 + seq % 11 ROWS UNBOUNDED PRECEDING) AS wid FROM ev),
{windows(GLOBAL, 600, "late", "wid")} SELECT series, window_id, {', '.join(COUNT_NAMES)} FROM w""",
    "stream_topk": f"""WITH {EV}, {sightings(GLOBAL, 3600, 3)},
{windows(GLOBAL, 3600)}
SELECT series, window_id, distinct_actors, dim, rk::INT AS rk, value, cnt FROM tk JOIN w USING (series, window_id)
WHERE (window_id + 1) * 3600000 <= (SELECT max(ts_us) // 1000 FROM ev)""",
    "stream_recorded_fold": f"{W600} SELECT series, window_id, {', '.join(COUNT_NAMES)} FROM w",
    "stream_scores": f"""{BY_TYPE_SCORES},
closed AS (SELECT series, max(window_id) AS last FROM w
           WHERE (window_id + 1) * 3600000 <= (SELECT max(ts_us) // 1000 FROM ev) GROUP BY 1)
SELECT s.series, window_id, 'zscore' AS name, z_flag AS flag, {r("z_score", 6, "score")}
FROM s JOIN closed c ON c.series = s.series AND window_id <= last
UNION ALL SELECT s.series, window_id, 'ewma', e_flag, {r("e_score", 6)}
FROM s JOIN closed c ON c.series = s.series AND window_id <= last""",
    "stream_anomalies": f"""WITH RECURSIVE {EV}, {windows(GLOBAL, 600)}, {dense()},
{zscore("(count / 600.0::DOUBLE)")}, {ewma("(count / 600.0::DOUBLE)")}, {hst(600)}, {ensemble3(600)},
{cooldown(2_400.0)}, {sightings(GLOBAL, 600)}, {BASE}, {WHY},
n AS (SELECT series, window_id, count(*) AS n_why FROM why GROUP BY ALL),
closed AS (SELECT max(window_id) AS last FROM w WHERE (window_id + 1) * 600000 <= (SELECT max(ts_us) // 1000 FROM ev))
SELECT 'metric' AS kind, NULL::VARCHAR AS id, (d.window_id + 1) * 600.0::DOUBLE AS t, d.count, NULL::VARCHAR AS severity,
       NULL::DOUBLE AS score, agreement::INT AS agreement, NULL::INT AS n_why
FROM dense d JOIN s ON s.window_id = d.window_id WHERE d.window_id <= (SELECT last FROM closed)
UNION ALL
SELECT 'anomaly', id, ts, NULL, severity, score, agreement, coalesce(n_why, 0)::INT
FROM surf LEFT JOIN n ON n.window_id = surf.window_id WHERE surf.window_id <= (SELECT last FROM closed)""",
    "stream_bootstrap": f"""WITH RECURSIVE {EV}, {windows(GLOBAL, 600)}, {dense()},
{zscore("(count / 600.0::DOUBLE)")}, {ewma("(count / 600.0::DOUBLE)")}, {hst(600)}
SELECT z.series, z.window_id, z_flag, e_flag, h_flag, {r("z_score", 6, "z_score")}, {r("e_score", 6, "e_score")},
       {r("h_score", 6, "h_score")}
FROM z JOIN e ON e.window_id = z.window_id JOIN h ON h.window_id = z.window_id
WHERE z.window_id <= (SELECT max(window_id) FROM w WHERE (window_id + 1) * 600000 <= (SELECT max(ts_us) // 1000 FROM ev))""",
    "stream_idle": f"""WITH {EV},
kept AS (SELECT * FROM ev WHERE event_type <> 'purchase' OR ts_us < 1704672000000000),
{windows(TYPE, 3600, "kept")}, {dense("(SELECT max(ts_us) FROM kept) // 3600000000 - 1")},
{sightings(TYPE, 3600)[1:].replace("FROM ev", "FROM kept")},
n AS (SELECT series, window_id, count(*) AS n_dims FROM tk GROUP BY ALL)
SELECT d.series, d.window_id, d.count, coalesce(n_dims, 0)::INT AS n_dims
FROM dense d LEFT JOIN n ON n.series = d.series AND n.window_id = d.window_id""",
    "stream_trailing": f"""WITH {EV},
p AS (SELECT event_type AS series, ts_us // 3600000000 AS hour, count(*) AS n FROM ev GROUP BY ALL),
c AS (SELECT series, hour + unnest(generate_series(1, 24)) AS hour, n FROM p)
SELECT series, hour * 3600 AS until, sum(n)::BIGINT AS trailing FROM c
WHERE hour * 3600000 <= (SELECT max(ts_us) // 1000 FROM ev) GROUP BY ALL""",
    "bm25": BM25,
    "keyword_category": category_sql(),
}
