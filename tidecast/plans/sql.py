"""DuckDB twins of the built-in operators, used by the oracle SQL.

These render the *same definitions* as the Spark operators so that the
driver can check each registered query against an independent engine.
"""

from __future__ import annotations

from tidecast.functions.calendar import sql_add_steps


def r6(expr: str) -> str:
    return f"round({expr}, 6)"


def stats_ctes(src: str, season: int = 7, window: int | None = None, p: str = "") -> str:
    """CTEs {p}obs, {p}st: per-series statistics over CTE ``src``."""
    mean = "avg(y)" if window is None else f"avg(CASE WHEN rd <= {window} THEN y END)"
    return f"""
{p}obs AS (
  SELECT unique_id, ds, y,
         row_number() OVER (PARTITION BY unique_id ORDER BY ds) - 1 AS pos,
         row_number() OVER (PARTITION BY unique_id ORDER BY ds DESC) AS rd
  FROM {src} WHERE y IS NOT NULL),
{p}lagged AS (
  SELECT unique_id, y, lag(y) OVER (PARTITION BY unique_id ORDER BY ds) AS lag_y FROM {src}),
{p}ob AS (
  SELECT unique_id, count(*) AS n_obs, arg_max(y, ds) AS last_y, arg_min(y, ds) AS first_y,
         {mean} AS mean_y, regr_slope(y, pos) AS trend_b, regr_intercept(y, pos) AS trend_a
  FROM {p}obs GROUP BY unique_id),
{p}ar AS (
  SELECT unique_id, regr_slope(y, lag_y) AS ar_b, regr_intercept(y, lag_y) AS ar_a
  FROM {p}lagged GROUP BY unique_id),
{p}st AS (
  SELECT s.unique_id, s.last_ds, coalesce(ob.n_obs, 0) AS n_obs, ob.last_y, ob.first_y,
         ob.mean_y, ob.trend_b, ob.trend_a, ar.ar_b, ar.ar_a
  FROM (SELECT unique_id, max(ds) AS last_ds FROM {src} GROUP BY unique_id) s
  LEFT JOIN {p}ob ob USING (unique_id) LEFT JOIN {p}ar ar USING (unique_id))"""


def yhat_sql(model: str, step: str = "step", season: int = 7, p: str = "") -> str:
    if model == "last":
        return "last_y"
    if model == "mean":
        return "mean_y"
    if model == "seasonal":
        k = f"least({season}, n_obs)"
        return (f"(SELECT o.y FROM {p}obs o WHERE o.unique_id = st.unique_id "
                f"AND o.rd = {k} - (({step} - 1) % {k}))")
    if model == "drift":
        return (f"last_y + CASE WHEN n_obs > 1 THEN (last_y - first_y) / (n_obs - 1) "
                f"ELSE 0.0 END * {step}")
    if model == "trend":
        return f"CASE WHEN trend_b IS NULL THEN last_y ELSE trend_a + trend_b * (n_obs - 1 + {step}) END"
    if model == "ar1":
        bk = f"power(ar_b, {step})"
        return (f"CASE WHEN ar_b IS NULL THEN last_y WHEN ar_b = 1.0 THEN ar_a * {step} + last_y "
                f"ELSE ar_a * (1 - {bk}) / (1 - ar_b) + {bk} * last_y END")
    raise ValueError(model)


def forecast_points_sql(src_sql: str, model: str, freq: str, h: int, season: int = 7,
                        window: int | None = None, round_yhat: bool = True) -> str:
    yhat = yhat_sql(model, 'step', season)
    return f"""WITH src AS ({src_sql}),{stats_ctes('src', season, window)}
SELECT st.unique_id, CAST(step AS INTEGER) AS step, {sql_add_steps('last_ds', 'step', freq)} AS ds,
       {r6(yhat) if round_yhat else yhat} AS yhat
FROM st, range(1, {int(h) + 1}) t(step)"""


def rebase_daily_sql(src_sql: str, keep: int = 1020, start: str = "2020-01-01") -> str:
    return f"""SELECT unique_id, CAST(DATE '{start}' + CAST(least(c, {keep}) - rn AS INTEGER) AS TIMESTAMP) AS ds, y
FROM (SELECT unique_id, y, row_number() OVER (PARTITION BY unique_id ORDER BY ds DESC) AS rn,
             count(*) OVER (PARTITION BY unique_id) AS c FROM ({src_sql}))
WHERE rn <= {keep}"""


def rebase_monthly_sql(src_sql: str, keep: int = 60, start: str = "2018-01-01") -> str:
    return f"""SELECT unique_id, CAST(last_day(DATE '{start}' + to_months(CAST(rn - 1 AS INTEGER))) AS TIMESTAMP) AS ds, y
FROM (SELECT unique_id, y, row_number() OVER (PARTITION BY unique_id ORDER BY ds) AS rn FROM ({src_sql}))
WHERE rn <= {keep}"""


def densify_sql(src_sql: str, freq: str = "D") -> str:
    if freq == "D":
        grid = ("SELECT unique_id, CAST(g.d AS TIMESTAMP) AS ds FROM spans, "
                "unnest(generate_series(CAST(s AS DATE), CAST(e AS DATE), INTERVAL 1 DAY)) g(d)")
    else:
        grid = ("SELECT unique_id, CAST(last_day(CAST(s AS DATE) + to_months(CAST(k AS INTEGER))) AS TIMESTAMP) AS ds "
                "FROM spans, unnest(generate_series(0, CAST(date_diff('month', CAST(s AS DATE), CAST(e AS DATE)) AS BIGINT))) g(k)")
    return f"""SELECT g.unique_id, g.ds, d.y FROM (
  WITH spans AS (SELECT unique_id, min(ds) AS s, max(ds) AS e FROM ({src_sql}) GROUP BY unique_id)
  {grid}) g LEFT JOIN ({src_sql}) d ON g.unique_id = d.unique_id AND g.ds = d.ds"""


def positioned_sql(src_sql: str) -> str:
    return (f"SELECT unique_id, ds, y, row_number() OVER (PARTITION BY unique_id ORDER BY ds) - 1 AS pos, "
            f"count(*) OVER (PARTITION BY unique_id) AS n FROM ({src_sql})")


def expand_sql(cuts_sql: str, pts_sql: str, key_cols: str, ctx: str, h: str) -> str:
    """Twin of splits._expand: cuts x rel in [-ctx, h) left-joined to points."""
    return f"""SELECT {key_cols}, c.cut, CAST(c.rel AS INTEGER) AS rel, p.ds, p.y,
       (c.cut + c.rel < 0) AS is_pad, (c.rel >= 0) AS is_future
FROM (SELECT *, unnest(generate_series(-({ctx}), ({h}) - 1)) AS rel FROM ({cuts_sql})) c
LEFT JOIN ({pts_sql}) p ON p.unique_id = c.unique_id AND p.pos = c.cut + c.rel"""


def specs_values(specs) -> str:
    rows = ", ".join(
        f"('{s['dataset']}', '{s['spec_id']}', {s['offset']}, {s['windows']}, {s['distance']}, "
        f"{s['prediction_length']}, {s['context_length']}, {s['patch_size']})" for s in specs)
    return (f"(SELECT * FROM (VALUES {rows}) v(dataset, spec_id, \"offset\", windows, distance, "
            f"prediction_length, context_length, patch_size))")


def rolling_windows_sql(src_sql: str, dataset: str, specs) -> str:
    pts = positioned_sql(src_sql)
    cuts = f"""SELECT l.unique_id, s.spec_id, CAST(w AS INTEGER) AS window_no,
  concat_ws('#', l.unique_id, s.spec_id, CAST(w AS VARCHAR)) AS window_id,
  CAST(CASE WHEN s."offset" >= 0 THEN s."offset" ELSE l.n + s."offset" END + w * s.distance AS INTEGER) AS cut,
  s.context_length, s.prediction_length
FROM (SELECT unique_id, '{dataset}' AS dataset, count(*) AS n FROM ({src_sql}) GROUP BY 1) l
JOIN {specs_values(specs)} s USING (dataset),
     unnest(generate_series(0, s.windows - 1)) g(w)
WHERE CASE WHEN s."offset" >= 0 THEN s."offset" ELSE l.n + s."offset" END + w * s.distance >= 0
  AND CASE WHEN s."offset" >= 0 THEN s."offset" ELSE l.n + s."offset" END + w * s.distance
      + s.prediction_length <= l.n"""
    return expand_sql(cuts, pts, "c.unique_id, c.spec_id, c.window_no, c.window_id",
                      "context_length", "prediction_length")


def observed_filter_sql(src_sql: str, min_length: int, max_missing: float) -> str:
    return f"""SELECT unique_id, ds, y FROM ({src_sql}) WHERE unique_id IN (
  SELECT unique_id FROM ({src_sql}) GROUP BY 1
  HAVING count(*) >= {min_length} AND avg(CASE WHEN y IS NULL THEN 1.0 ELSE 0.0 END) <= {max_missing})"""


def impute_sql(src_sql: str) -> str:
    return f"""SELECT unique_id, ds, coalesce(y,
  last_value(y IGNORE NULLS) OVER (PARTITION BY unique_id ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(y IGNORE NULLS) OVER (PARTITION BY unique_id ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING),
  0.0) AS y FROM ({src_sql})"""


def random_drop_sql(src_sql: str, drop_prob: float, seed: int) -> str:
    from tidecast.functions.rng import sql_uniform
    u = sql_uniform(seed, "unique_id", "strftime(ds, '%Y%m%d%H%M%S')")
    p = f"({sql_uniform(seed, 'unique_id', chr(39) + 'p' + chr(39))} * {float(drop_prob)!r})"
    return f"SELECT unique_id, ds, CASE WHEN {u} < {p} THEN NULL ELSE y END AS y FROM ({src_sql})"


def random_cuts_sql(src_sql: str, min_past: int, h: int, num: float, seed: int) -> str:
    from tidecast.functions.rng import sql_uniform
    return f"""WITH pts AS ({positioned_sql(src_sql)}),
avgv AS (SELECT avg(n - {h} - {min_past} + 1) AS a FROM (SELECT unique_id, max(n) AS n FROM pts GROUP BY 1)
         WHERE n - {h} - {min_past} + 1 > 0),
u AS (SELECT *, {sql_uniform(seed, 'unique_id', 'pos')} AS u FROM pts WHERE pos >= {min_past} AND pos <= n - {h}),
um AS (SELECT *, min(u) OVER (PARTITION BY unique_id) AS umin FROM u)
SELECT unique_id, CAST(pos AS INTEGER) AS cut, ds AS forecast_start FROM um, avgv WHERE u < {float(num)} / a OR u = umin"""


def context_window_sql(src_sql: str, cuts_sql: str, ctx: int, h: int) -> str:
    cuts = (f"SELECT unique_id, cut, forecast_start, concat_ws('#', unique_id, CAST(cut AS VARCHAR)) AS window_id "
            f"FROM ({cuts_sql})")
    return expand_sql(cuts, positioned_sql(src_sql), "c.unique_id, c.window_id, c.forecast_start", str(ctx), str(h))


def nonempty_sql(wins_sql: str) -> str:
    return f"""SELECT * FROM ({wins_sql}) WHERE window_id IN (
  SELECT window_id FROM ({wins_sql}) GROUP BY 1 HAVING count(CASE WHEN NOT is_future THEN y END) > 0)"""


def token_rows_sql(wins_sql: str, ctx: int, h: int, model_type: str) -> str:
    """Long token rows (window_id, part, idx, token, mask) for a window table."""
    from tidecast.functions.tokens import sql_token_id
    base = f"""WITH w AS (SELECT *, avg(CASE WHEN NOT is_future THEN abs(y) END) OVER (PARTITION BY window_id) AS m
                FROM ({wins_sql})),
t AS (SELECT window_id, rel, is_pad, is_future, y IS NOT NULL AS ob,
             CASE WHEN y IS NOT NULL THEN {sql_token_id('y / (CASE WHEN m > 0 THEN m ELSE 1.0 END)')} ELSE 0 END AS tok
      FROM w)"""
    if model_type == "seq2seq":
        return base + f"""
SELECT window_id, 'input' AS part, CAST(rel + {ctx} AS INTEGER) AS idx, tok AS token, ob AS mask FROM t WHERE NOT is_future
UNION ALL SELECT DISTINCT window_id, 'input', {ctx}, 1, true FROM t
UNION ALL SELECT window_id, 'label', CAST(rel AS INTEGER), CASE WHEN ob THEN tok ELSE -100 END, ob FROM t WHERE is_future
UNION ALL SELECT DISTINCT window_id, 'label', {h}, 1, true FROM t"""
    return base + f""",
np AS (SELECT window_id, count(CASE WHEN is_pad THEN 1 END) AS npad FROM t GROUP BY 1),
seq AS (
  SELECT t.window_id, CAST(CASE WHEN is_future THEN {ctx} - npad + rel
                               WHEN is_pad THEN {ctx} - npad + {h} + 1 + (rel + {ctx})
                               ELSE rel + {ctx} - npad END AS INTEGER) AS idx,
         CASE WHEN is_pad THEN 0 ELSE tok END AS tok, (ob AND NOT is_pad) AS mk
  FROM t JOIN np USING (window_id)
  UNION ALL SELECT window_id, CAST({ctx} - npad + {h} AS INTEGER), 1, true FROM np)
SELECT window_id, 'input' AS part, idx, CASE WHEN mk THEN tok ELSE 0 END AS token, mk AS mask FROM seq
UNION ALL SELECT window_id, 'label', idx, CASE WHEN mk THEN tok ELSE -100 END, mk FROM seq"""


def forecast_samples_sql(src_sql: str, h: int, num_samples: int, seed: int, freq: str = "D") -> str:
    from tidecast.functions.rng import sql_uniform
    return f"""WITH src AS ({src_sql}),
obs AS (SELECT unique_id, ds, y FROM src WHERE y IS NOT NULL),
res AS (SELECT unique_id, row_number() OVER (PARTITION BY unique_id ORDER BY ds) AS idx, r FROM (
          SELECT unique_id, ds, y - lag(y) OVER (PARTITION BY unique_id ORDER BY ds) AS r FROM obs) WHERE r IS NOT NULL),
st AS (SELECT unique_id, max(ds) AS last_ds, arg_max(y, ds) FILTER (WHERE y IS NOT NULL) AS last_y,
              count(y) - 1 AS m FROM src GROUP BY 1),
paths AS (SELECT unique_id, last_ds, last_y, s AS sample, k AS step,
                 CASE WHEN m > 0 THEN CAST(floor({sql_uniform(seed, 'unique_id', 's', 'k')} * m) + 1 AS BIGINT) END AS idx
          FROM st, range(0, {num_samples}) a(s), range(1, {h + 1}) b(k))
SELECT p.unique_id, CAST(sample AS INTEGER) AS sample, CAST(step AS INTEGER) AS step,
       {sql_add_steps('last_ds', 'step', freq)} AS ds,
       last_y + sum(coalesce(r, 0.0)) OVER (PARTITION BY p.unique_id, sample ORDER BY step
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
FROM paths p LEFT JOIN res ON res.unique_id = p.unique_id AND res.idx = p.idx"""


def last_points_sql(src_sql: str, context: int) -> str:
    return f"""SELECT unique_id, ds, y FROM (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY ds DESC) AS rd
FROM ({src_sql})) WHERE rd <= {context}"""


def scaled_pairs_sql(src_sql: str) -> str:
    return f"""SELECT unique_id, ds, y / s AS y_, lag(y) OVER (PARTITION BY unique_id ORDER BY ds) / s AS x_ FROM (
  SELECT *, CASE WHEN avg(abs(y)) OVER (PARTITION BY unique_id) > 0 THEN avg(abs(y)) OVER (PARTITION BY unique_id)
                 ELSE 1.0 END AS s FROM ({src_sql}))"""


def registry_history_sql(src_sql: str, name: str) -> str:
    return f"""WITH p AS (SELECT * FROM ({scaled_pairs_sql(src_sql)}) WHERE x_ IS NOT NULL AND y_ IS NOT NULL),
m AS (SELECT CAST(last_day(CAST(ds AS DATE)) AS TIMESTAMP) AS month, count(*) AS n, sum(x_) AS sx, sum(y_) AS sy,
             sum(x_ * x_) AS sxx, sum(x_ * y_) AS sxy FROM p GROUP BY 1),
c AS (SELECT month, sum(n) OVER w AS n, sum(sx) OVER w AS sx, sum(sy) OVER w AS sy, sum(sxx) OVER w AS sxx,
             sum(sxy) OVER w AS sxy, row_number() OVER (ORDER BY month) AS v
      FROM m WINDOW w AS (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
f AS (SELECT *, CASE WHEN n * sxx - sx * sx <> 0 THEN (n * sxy - sx * sy) / (n * sxx - sx * sx) END AS slope FROM c)
SELECT '{name}' AS name, CAST(v AS VARCHAR) AS version, slope, (sy - slope * sx) / n AS intercept,
       CAST(n AS BIGINT) AS n, month AS trained_through FROM f"""


def backtest_metrics_sql(src_sql: str, dataset: str, h: int, windows: int, context: int,
                         freq: str = "D", models=("last", "seasonal", "mean", "drift", "trend", "ar1"),
                         season: int = 7) -> str:
    spec = dict(dataset=dataset, spec_id=f"{dataset}/h{h}/c{context}/p1", offset=-(windows * h),
                windows=windows, distance=h, prediction_length=h, context_length=context, patch_size=1)
    wins = rolling_windows_sql(src_sql, dataset, [spec])
    preds = " UNION ALL ".join(
        f"SELECT st.unique_id AS window_id, step, '{m}' AS model, CAST({yhat_sql(m, 'step', season)} AS DOUBLE) AS yhat "
        f"FROM st, range(1, {h + 1}) t(step)" for m in models)
    return f"""WITH wins AS ({wins}),
past AS (SELECT window_id AS unique_id, ds, y FROM wins WHERE NOT is_future AND NOT is_pad),{stats_ctes('past', season)},
preds AS ({preds}),
fut AS (SELECT window_id, window_no, rel + 1 AS step, y AS actual FROM wins WHERE is_future),
j AS (SELECT * FROM preds JOIN fut USING (window_id, step) WHERE actual IS NOT NULL AND yhat IS NOT NULL)
SELECT model AS run, window_no AS epoch, 'val/MSE' AS metric, avg((actual - yhat) * (actual - yhat)) AS value FROM j GROUP BY 1, 2
UNION ALL
SELECT model AS run, window_no AS epoch, 'val/MAE' AS metric, avg(abs(actual - yhat)) AS value FROM j GROUP BY 1, 2"""
