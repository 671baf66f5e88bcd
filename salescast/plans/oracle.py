"""DuckDB SQL for every query that SQL can express, on the same Parquet tables."""

from __future__ import annotations

from salescast.schema import INTERVALS, LEVELS, MONITORED_COLS, Settings, q_name

S = Settings()
Q = sorted(S.quantiles)
QN = [q_name(q) for q in Q]
H = S.horizon

BASE = """
WITH dims AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_quantity, p_retailprice,
         p_type || '_' || (CAST(replace(p_brand,'Brand#','') AS INTEGER) % 4) AS item_id, p_type AS dept_id,
         CASE WHEN p_type IN ('SMALL','MEDIUM','LARGE') THEN 'SIZED' ELSE 'VALUE' END AS cat_id,
         r_name || '_' || (n_nationkey % 2) AS store_id, r_name AS state_id
  FROM lineitem JOIN part ON l_partkey=p_partkey JOIN supplier ON l_suppkey=s_suppkey
       JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey),
bounds AS (SELECT min(date) AS d0, max(date) AS d1 FROM dims),
cal AS (SELECT d, date, CAST(1+(d-1)//7 AS INTEGER) AS wm_yr_wk, strftime(date,'%A') AS weekday,
    CAST((dayofweek(date)+1)%7+1 AS INTEGER) AS wday, CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year,
    CASE strftime(date,'%m-%d') WHEN '12-25' THEN 'Christmas' WHEN '07-04' THEN 'IndependenceDay' WHEN '02-14' THEN 'ValentinesDay' END AS event_name_1,
    CASE strftime(date,'%m-%d') WHEN '12-25' THEN 'National' WHEN '07-04' THEN 'National' WHEN '02-14' THEN 'Cultural' END AS event_type_1,
    CAST(day(date)<=10 AND day(date)%2=0 AS INTEGER) AS snap_even, CAST(day(date)<=10 AND day(date)%2=1 AS INTEGER) AS snap_odd
  FROM (SELECT CAST(i AS INTEGER) AS d, CAST(d0 + CAST(i-1 AS INTEGER) AS DATE) AS date
        FROM bounds, range(1, date_diff('day', d0, d1)+2) t(i))),
ser AS (SELECT DISTINCT store_id||'|'||item_id AS id, item_id, dept_id, cat_id, store_id, state_id FROM dims),
day AS (SELECT store_id||'|'||item_id AS id, date, sum(l_quantity) AS q FROM dims GROUP BY 1,2),
sales_long AS (SELECT ser.*, cal.* EXCLUDE (snap_even, snap_odd, weekday),
   CASE WHEN state_id IN ('AFRICA','ASIA') THEN snap_even WHEN state_id IN ('AMERICA','EUROPE') THEN snap_odd ELSE 0 END AS snap,
   CAST(coalesce(q,0) AS INTEGER) AS sales
               FROM ser CROSS JOIN cal LEFT JOIN day ON day.id=ser.id AND day.date=cal.date),
wk AS (SELECT store_id, item_id, wm_yr_wk, max(p_retailprice) AS p FROM dims JOIN cal USING(date) GROUP BY 1,2,3),
wkgrid AS (SELECT s.store_id, s.item_id, s.dept_id, w.wm_yr_wk, wk.p FROM ser s CROSS JOIN (SELECT DISTINCT wm_yr_wk FROM cal) w
           LEFT JOIN wk ON wk.store_id=s.store_id AND wk.item_id=s.item_id AND wk.wm_yr_wk=w.wm_yr_wk),
prices0 AS (SELECT store_id,item_id,dept_id,wm_yr_wk, last_value(p IGNORE NULLS) OVER (PARTITION BY store_id,item_id ORDER BY wm_yr_wk ROWS UNBOUNDED PRECEDING) AS sell_price FROM wkgrid),
prices AS (SELECT * FROM prices0 WHERE sell_price IS NOT NULL),
pf AS (SELECT *, sell_price/lag(sell_price) OVER (PARTITION BY store_id,item_id ORDER BY wm_yr_wk)-1 AS price_pct_change,
        sell_price/(avg(CAST(round(sell_price*1000000) AS BIGINT)) OVER (PARTITION BY store_id,dept_id,wm_yr_wk)/1000000.0) AS price_rel_dept FROM prices),
feat0 AS (SELECT sl.*, pf.sell_price, pf.price_pct_change, pf.price_rel_dept,
   lag(sales,7) OVER w AS lag_7, lag(sales,28) OVER w AS lag_28,
   CASE WHEN count(sales) OVER w7>=7 THEN avg(sales) OVER w7 END AS rolling_mean_7,
   CASE WHEN count(sales) OVER w7>=7 THEN stddev_samp(sales) OVER w7 END AS rolling_std_7,
   CASE WHEN count(sales) OVER w28>=28 THEN avg(sales) OVER w28 END AS rolling_mean_28,
   CASE WHEN count(sales) OVER w28>=28 THEN stddev_samp(sales) OVER w28 END AS rolling_std_28
   FROM sales_long sl LEFT JOIN pf USING (store_id,item_id,wm_yr_wk)
   WINDOW w AS (PARTITION BY id ORDER BY d), w7 AS (PARTITION BY id ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
          w28 AS (PARTITION BY id ORDER BY d ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)),
feat AS MATERIALIZED (SELECT * FROM feat0 WHERE sell_price IS NOT NULL),
lastd AS (SELECT max(d) AS last FROM feat)
"""

IDS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
DYN_INT = ["lag_7", "lag_28"]
DYN_DBL = ["rolling_mean_7", "rolling_std_7", "rolling_mean_28", "rolling_std_28"]


def cols(names, alias: str = "") -> str:
    dot = f"{alias}." if alias else ""
    return ", ".join(f"{dot}{n}" for n in names)


def r6(*names: str, alias: str = "") -> str:
    dot = f"{alias}." if alias else ""
    return ", ".join(f"round({dot}{n}, 6) AS {n}" for n in names)


def sql(*ctes: str, select: str) -> str:
    return BASE + "".join(f",\n{c}" for c in ctes) + "\n" + select


# -- shared CTEs ----------------------------------------------------------------------------

def origin_cte(n: int, stride: int) -> str:
    return (
        f"orig AS (SELECT CAST(last-{H}-{stride}*i AS INTEGER) AS origin FROM lastd, range({n}) t(i) "
        f"WHERE last-{H}-{stride}*i > 0)"
    )


LATEST = origin_cte(1, 1)
FOLDS = origin_cte(S.n_folds, S.fold_stride)
TRAIN = origin_cte(S.n_train_origins, S.origin_stride)


def fixed_origin(day: int) -> str:
    return f"orig AS (SELECT CAST({day} AS INTEGER) AS origin)"


DIRECT = f"""direct AS (SELECT {cols(IDS, 'k')}, o.origin, t.d-o.origin AS horizon, t.d AS target_day, t.sales,
   {cols(DYN_INT + DYN_DBL, 'k')}, t.wday, t.month, t.event_name_1, t.event_type_1, t.snap, t.sell_price, t.price_rel_dept
   FROM orig o JOIN feat k ON k.d=o.origin+1 JOIN feat t ON t.id=k.id AND t.d>o.origin AND t.d<=o.origin+{H})"""

PRIORS = f"""priors AS (SELECT origin, store_id, dept_id, quantile_cont(CAST(sales AS DOUBLE), {Q}) AS qs
   FROM feat JOIN orig ON d<=origin AND d>origin-{S.prior_window} GROUP BY 1,2,3)"""

Q_FILLED = ", ".join(f"coalesce(qs[{i + 1}], 0.0) AS {n}" for i, n in enumerate(QN))
PRED = f"""pred AS (SELECT {cols(IDS, 'x')}, x.origin, x.horizon, x.target_day, x.sales AS actual, {Q_FILLED}
   FROM direct x LEFT JOIN priors p ON p.origin=x.origin AND p.store_id=x.store_id AND p.dept_id=x.dept_id)"""
NAIVE_Q = ", ".join(f"CAST(coalesce(r.sales, 0) AS DOUBLE) AS {n}" for n in QN)
NAIVE = f"""naive AS (SELECT {cols(IDS, 'x')}, x.origin, x.horizon, x.target_day, x.sales AS actual, {NAIVE_Q}
   FROM direct x LEFT JOIN feat r ON r.id=x.id AND r.d = x.target_day - 7*((x.horizon+6)//7))"""

BACKTEST = (FOLDS, DIRECT, PRIORS, PRED)

COLD = f"""cold AS MATERIALIZED (SELECT id, count(*) AS n_days FROM feat, orig WHERE d<=origin GROUP BY id HAVING count(*)<{S.min_history})"""
PRED_KEYS = f"{cols(IDS)}, origin, horizon, target_day"
CATALOGUE = f"""cat0 AS (
   SELECT {PRED_KEYS}, {cols(QN)}, false AS is_cold_start FROM pred ANTI JOIN cold USING (id)
   UNION ALL
   SELECT {cols(IDS, 's')}, o.origin, CAST(h AS INTEGER) AS horizon, CAST(o.origin+h AS INTEGER) AS target_day, {Q_FILLED}, true AS is_cold_start
   FROM (SELECT DISTINCT {cols(IDS)} FROM feat SEMI JOIN cold USING (id)) s CROSS JOIN orig o CROSS JOIN range(1,{H + 1}) t(h)
   LEFT JOIN priors p ON p.origin=o.origin AND p.store_id=s.store_id AND p.dept_id=s.dept_id)"""
# The newest batch of the archive: one origin, whose series are all warm or cold by the same rule.
BATCH = (LATEST, DIRECT, PRIORS, PRED, COLD, CATALOGUE)
RUN_DATE = "strftime((SELECT d0 FROM bounds) + CAST(origin-1 AS INTEGER), '%Y-%m-%d')"


def wape(a: str = "actual", p: str = "q50") -> str:
    return f"CASE WHEN sum(abs({a}))>0 THEN sum(abs({a}-{p}))/sum(abs({a})) END"


def pin(a: str, p: str, q: float) -> str:
    return f"avg(greatest({q}*({a}-{p}), ({q}-1.0)*({a}-{p})))"


def mean_pin(a: str = "actual") -> str:
    return "(" + "+".join(pin(a, n, q) for q, n in zip(Q, QN)) + f")/{len(Q)}"


def cover(n: int) -> str:
    lo, hi = INTERVALS[n]
    return f"avg(CASE WHEN actual>={q_name(lo)} AND actual<={q_name(hi)} THEN 1.0 ELSE 0.0 END)"


COVERS = ", ".join(f"round({cover(n)}, 6) AS coverage_{n}" for n in INTERVALS)


# -- panel ------------------------------------------------------------------------------------

def level_key(keys: list[str]) -> str:
    return "||'/'||".join(keys) if keys else "''"


def leveled(source: str, value_sql: str, day: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS level, {level_key(keys)} AS key, {day} AS day, {value_sql} FROM {source} GROUP BY 1,2,3"
        for name, keys in LEVELS.items()
    )


HIST = "hist AS (SELECT * FROM feat WHERE d <= (SELECT min(origin) FROM orig))"


def panel_ctes(pred: str, tag: str, hist: str = "hist") -> list[str]:
    weights = " UNION ALL ".join(
        f"SELECT '{name}' AS level, {level_key(keys)} AS key, sum(weight) AS weight FROM mem_{tag} GROUP BY 1,2"
        for name, keys in LEVELS.items() if keys
    )
    return [
        f"dw_{tag} AS (SELECT id, sum(sell_price*sales) AS weight FROM {hist} WHERE d > (SELECT max(d) FROM {hist})-28 GROUP BY id)",
        f"mem_{tag} AS (SELECT DISTINCT {cols(IDS, 'p')}, w.weight FROM {pred} p JOIN dw_{tag} w ON w.id=p.id)",
        f"gw_{tag} AS ({weights})",
        f"hl_{tag} AS ({leveled(hist, 'CAST(sum(sales) AS DOUBLE) AS y', 'd')})",
        f"hs_{tag} AS (SELECT level, key, avg(abs(y-y7)) AS smae, avg((y-y1)*(y-y1)) AS nmse FROM ("
        f"SELECT *, lag(y,7) OVER w AS y7, lag(y,1) OVER w AS y1 FROM hl_{tag} WINDOW w AS (PARTITION BY level,key ORDER BY day)) GROUP BY 1,2)",
        f"pl_{tag} AS ({leveled(pred, 'CAST(sum(actual) AS DOUBLE) AS a, sum(q50) AS f', 'target_day')})",
        f"ge_{tag} AS (SELECT level, key, sum(abs(a-f)) AS ae, sum(abs(a)) AS vol, avg(abs(a-f)) AS mae, avg((a-f)*(a-f)) AS mse FROM pl_{tag} GROUP BY 1,2)",
        f"gg_{tag} AS (SELECT e.level, ae, vol, CASE WHEN smae>0 THEN mae/smae END AS mase, CASE WHEN nmse>0 THEN sqrt(mse/nmse) END AS rmsse, "
        f"CASE WHEN e.level='total' THEN 1.0 ELSE coalesce(w.weight,0) END AS w FROM ge_{tag} e "
        f"LEFT JOIN hs_{tag} h ON h.level=e.level AND h.key=e.key LEFT JOIN gw_{tag} w ON w.level=e.level AND w.key=e.key)",
        f"lv_{tag} AS (SELECT level, count(*) AS n_groups, CASE WHEN sum(vol)>0 THEN sum(ae)/sum(vol) END AS wape, "
        f"sum(mase*w)/nullif(sum(CASE WHEN mase IS NOT NULL THEN w END),0) AS mase, "
        f"sum(rmsse*w)/nullif(sum(CASE WHEN rmsse IS NOT NULL THEN w END),0) AS rmsse FROM gg_{tag} GROUP BY level)",
    ]


# -- drift ------------------------------------------------------------------------------------

def drift_ctes(features: list[str]) -> list[str]:
    vals = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CASE WHEN d > last-{S.drift_window} THEN 'cur' ELSE 'ref' END AS side, CAST({f} AS DOUBLE) AS v "
        f"FROM feat, lastd WHERE d > last-2*{S.drift_window} AND {f} IS NOT NULL"
        for f in features
    )
    probs = ", ".join(f"({p!r})" for p in [i * 0.1 for i in range(10)] + [1.0])
    return [
        f"vals AS ({vals})",
        "ranks AS (SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY v)-1 AS r FROM vals WHERE side='ref')",
        f"pos AS (SELECT feature, CAST(n-1 AS DOUBLE)*CAST(p AS DOUBLE) AS pos FROM (SELECT feature, count(*) AS n FROM ranks GROUP BY 1) CROSS JOIN (VALUES {probs}) t(p))",
        "edge AS (SELECT DISTINCT pos.feature, lo.v + (hi.v-lo.v)*(pos-floor(pos)) AS e FROM pos "
        "JOIN ranks lo ON lo.feature=pos.feature AND lo.r=CAST(floor(pos) AS BIGINT) JOIN ranks hi ON hi.feature=pos.feature AND hi.r=CAST(ceil(pos) AS BIGINT))",
        "numbered AS (SELECT feature, e, row_number() OVER (PARTITION BY feature ORDER BY e) AS i, count(*) OVER (PARTITION BY feature) AS ne FROM edge)",
        "counted AS (SELECT feature, side, v, count(*) AS c FROM vals GROUP BY 1,2,3)",
        "placed AS (SELECT c.feature, c.side, c.v, c.c, count(n.e) AS bin FROM counted c LEFT JOIN numbered n ON n.feature=c.feature AND n.i>1 AND n.i<n.ne AND n.e<=c.v GROUP BY 1,2,3,4)",
        "cells AS (SELECT feature, bin, sum(CASE WHEN side='ref' THEN c ELSE 0 END) AS r, sum(CASE WHEN side='cur' THEN c ELSE 0 END) AS k FROM placed GROUP BY 1,2)",
        "shares AS (SELECT feature, greatest(r/sum(r) OVER (PARTITION BY feature), 1e-6) AS r, greatest(k/sum(k) OVER (PARTITION BY feature), 1e-6) AS k, "
        "sum(r) OVER (PARTITION BY feature) AS nr, sum(k) OVER (PARTITION BY feature) AS nk FROM cells)",
        "scored AS (SELECT feature, sum((k-r)*ln(k/r)) AS psi FROM shares WHERE nr>0 AND nk>0 AND feature IN (SELECT feature FROM numbered WHERE ne>=2) GROUP BY 1)",
        "drift AS (SELECT f.feature, coalesce(psi, 0.0) AS psi, coalesce(psi, 0.0) > 0.2 AS drifted FROM (VALUES "
        + ", ".join(f"('{f}')" for f in features) + ") f(feature) LEFT JOIN scored USING (feature))",
    ]


SUMMARY = (
    *BATCH,
    *drift_ctes(MONITORED_COLS),
    "joined AS (SELECT c.*, t.sales AS actual FROM cat0 c JOIN feat t ON t.id=c.id AND t.d=c.target_day)",
    f"head AS (SELECT (SELECT CASE WHEN count(*)=0 THEN -1.0 ELSE {wape()} END FROM joined) AS forecast_wape, (SELECT max(psi) FROM drift) AS max_psi, "
    "(SELECT count(*) FILTER (WHERE drifted) FROM drift) AS n_drifted, (SELECT count(*) FROM joined) AS n_scored, (SELECT count(DISTINCT id) FROM cat0) AS n_series)",
)

RAW_Q = """rawq AS (SELECT id, d, rolling_mean_7-1.645*rolling_std_7 AS q05, rolling_mean_28-0.674*rolling_std_28 AS q25, rolling_mean_7 AS q50,
   rolling_mean_28+0.674*rolling_std_28 AS q75, rolling_mean_7+1.645*rolling_std_7 AS q95 FROM feat WHERE rolling_std_28 IS NOT NULL)"""
MONO_Q = f"""monoq AS (SELECT id, d, {', '.join(f's[{i + 1}] AS {n}' for i, n in enumerate(QN))} FROM (
   SELECT id, d, list_sort([{', '.join(f'greatest({n}, 0.0)' for n in QN)}]) AS s FROM rawq))"""
NEG = f"least({cols(QN)}) < 0"
CROSS = "(" + " OR ".join(f"{b}-{a} < -1e-6" for a, b in zip(QN, QN[1:])) + ")"


def gate(name: str, source: str) -> str:
    return (
        f"SELECT count(*) AS n_rows, count(*) FILTER (WHERE {NEG}) AS n_negative, count(*) FILTER (WHERE {CROSS}) AS n_crossing, '{name}' AS batch, "
        f"count(*) FILTER (WHERE {NEG})=0 AND count(*) FILTER (WHERE {CROSS})=0 AS accepted FROM {source}"
    )


def sample_ids(where: str, n: int) -> str:
    return f"(SELECT id FROM (SELECT DISTINCT id FROM feat {where}) ORDER BY md5(id||'|42'), id LIMIT {n})"


ASIA_SAMPLE = sample_ids("WHERE state_id='ASIA'", 20)
REGISTRY = (
    *BACKTEST,
    f"reg AS (SELECT CAST(row_number() OVER (ORDER BY origin) AS INTEGER) AS version, origin AS created, "
    f"CASE WHEN origin=(SELECT max(origin) FROM orig) THEN 'PendingManualApproval' ELSE 'Approved' END AS status, wape "
    f"FROM (SELECT origin, {wape()} AS wape FROM pred GROUP BY origin))",
)
BUCKET = "CAST('0x'||substr(md5(id),1,8) AS BIGINT) % 100"
FEATURE_COLS = (
    f"{cols(IDS)}, d, date, wm_yr_wk, wday, month, year, event_name_1, event_type_1, snap, sales, "
    f"{r6('sell_price', 'price_pct_change', 'price_rel_dept')}, lag_7, lag_28, {r6(*DYN_DBL)}"
)
EVENT_CODE = (
    "(SELECT event_name_1 AS v, CAST(row_number() OVER (ORDER BY event_name_1)-1 AS INTEGER) AS c "
    "FROM (SELECT DISTINCT event_name_1 FROM feat WHERE event_name_1 IS NOT NULL))"
)
TYPE_CODE = EVENT_CODE.replace("event_name_1", "event_type_1")
EVENT_TIME = "strftime((SELECT d0 FROM bounds) + CAST(d-1 AS INTEGER), '%Y-%m-%d')||'T00:00:00Z'"


def units(column: str, tail: str = "") -> str:
    return sql(select=f"SELECT {column}, CAST(sum(sales) AS BIGINT) AS total_units FROM sales_long GROUP BY 1 ORDER BY 2 DESC, 1 {tail}")


def filled(column: str) -> str:
    return (
        f"coalesce(last_value({column} IGNORE NULLS) OVER (PARTITION BY id ORDER BY d ROWS UNBOUNDED PRECEDING), "
        f"first_value({column} IGNORE NULLS) OVER (PARTITION BY id ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"
    )


ORACLE: dict[str, str] = {}

# -- features ------------------------------------------------------------------------------------
ORACLE["features"] = sql(select=f"SELECT {FEATURE_COLS} FROM feat")
ORACLE["sales_long"] = sql(select=f"SELECT {cols(IDS)}, d, sales FROM sales_long")
ORACLE["melt_wide"] = ORACLE["sales_long"]
ORACLE["calendar_snap"] = sql(
    select="SELECT id, state_id, d, sales, date, wm_yr_wk, wday, month, year, event_name_1, event_type_1, snap FROM sales_long"
)
ORACLE["price_features"] = sql(
    select=f"SELECT id, d, {r6('sell_price', 'price_pct_change', 'price_rel_dept')} FROM feat0"
)
ORACLE["lag_features"] = sql(select="SELECT id, d, lag_7, lag_28 FROM feat0")
ORACLE["rolling_features"] = sql(select=f"SELECT id, d, {r6(*DYN_DBL)} FROM feat0")
ORACLE["pre_release_drop"] = sql(select=f"SELECT id, d, sales, {r6('sell_price')} FROM feat")

# -- sources and sinks ---------------------------------------------------------------------------
ORACLE["ingest_roundtrip"] = sql(select="""
SELECT 'sales' AS table_name, count(*) AS n_rows, count(DISTINCT (id, d)) AS n_keys, CAST(sum(sales) AS BIGINT) AS total FROM sales_long
UNION ALL SELECT 'calendar', count(*), count(DISTINCT date), CAST(sum(wm_yr_wk) AS BIGINT) FROM cal
UNION ALL SELECT 'prices', count(*), count(DISTINCT (store_id, item_id, wm_yr_wk)), CAST(sum(CAST(round(sell_price*100) AS BIGINT)) AS BIGINT) FROM prices""")
ORACLE["load_features"] = sql(
    select=f"SELECT {cols(IDS)}, d, sales, lag_7, lag_28, {r6(*DYN_DBL)}, wday, month, event_name_1, event_type_1, snap, {r6('sell_price', 'price_rel_dept')} "
    f"FROM feat WHERE state_id='ASIA' AND id IN {ASIA_SAMPLE}"
)
ORACLE["archive_roundtrip"] = sql(
    FOLDS, DIRECT, PRIORS, PRED,
    f"cold AS (SELECT id, origin, count(*) AS n FROM feat, orig WHERE d<=origin GROUP BY 1,2 HAVING count(*)<{S.min_history})",
    f"""arch AS (SELECT {PRED_KEYS}, {cols(QN)}, false AS is_cold_start FROM pred WHERE NOT EXISTS (SELECT 1 FROM cold c WHERE c.id=pred.id AND c.origin=pred.origin)
   UNION ALL SELECT {cols(IDS, 's')}, c.origin, CAST(h AS INTEGER), CAST(c.origin+h AS INTEGER), {Q_FILLED}, true
   FROM cold c JOIN ser s ON s.id=c.id CROSS JOIN range(1,{H + 1}) t(h) LEFT JOIN priors p ON p.origin=c.origin AND p.store_id=s.store_id AND p.dept_id=s.dept_id)""",
    select=f"SELECT {PRED_KEYS}, {r6(*QN)}, is_cold_start, {RUN_DATE} AS run_date, 'store-department-prior' AS model_name, 'o'||origin AS model_version "
    "FROM arch WHERE origin > (SELECT min(origin) FROM orig)",
)
ORACLE["latest_archive"] = sql(
    *BATCH, select=f"SELECT {RUN_DATE} AS run_date, 'o'||origin AS model_version, id, origin, horizon, {r6('q50')} FROM cat0"
)
ORACLE["batch_inputs"] = sql(
    LATEST, DIRECT,
    select=f"SELECT id, origin, target_day, {cols(IDS[1:])}, wday, month, event_name_1, event_type_1, snap, lag_7, lag_28, {r6(*DYN_DBL)}, horizon, {r6('sell_price', 'price_rel_dept')} FROM direct",
)
ORACLE["series_json"] = sql(
    "stc AS (SELECT store_id, CAST(row_number() OVER (ORDER BY store_id)-1 AS INTEGER) AS c FROM (SELECT DISTINCT store_id FROM sales_long))",
    "dpc AS (SELECT dept_id, CAST(row_number() OVER (ORDER BY dept_id)-1 AS INTEGER) AS c FROM (SELECT DISTINCT dept_id FROM sales_long))",
    "fp AS (SELECT id, min(d) AS f FROM sales_long WHERE sales>0 GROUP BY 1)",
    "packed AS (SELECT s.id, min(f) AS f, list(sales ORDER BY d) AS target, min(stc.c) AS sc, min(dpc.c) AS dc FROM sales_long s JOIN fp ON fp.id=s.id AND s.d>=f JOIN stc USING (store_id) JOIN dpc USING (dept_id) GROUP BY s.id)",
    f"kept AS (SELECT * FROM packed WHERE len(target)-{H}>{H})",
    "txt AS (SELECT *, strftime((SELECT d0 FROM bounds) + CAST(f-1 AS INTEGER), '%Y-%m-%d') AS st FROM kept)",
    select="""SELECT 'train' AS split, id, '{"start":"'||st||'","target":['||array_to_string(target[1:len(target)-%d], ',')||'],"cat":['||sc||','||dc||']}' AS line FROM txt
UNION ALL SELECT 'test', id, '{"start":"'||st||'","target":['||array_to_string(target, ',')||'],"cat":['||sc||','||dc||']}' FROM txt""" % H,
)

# -- filters, sampling, grids ----------------------------------------------------------------------
ORACLE["cap_series"] = sql(select=f"SELECT id, d, sales FROM feat WHERE id IN {sample_ids('', 50)}")
ORACLE["filter_state"] = sql(select="SELECT id, state_id, d, sales FROM feat WHERE state_id='ASIA'")
ORACLE["select_series"] = sql(
    FOLDS,
    select="SELECT id, count(*) AS n_days FROM feat WHERE d <= (SELECT min(origin) FROM orig) GROUP BY id HAVING count(*)>=84 ORDER BY md5(id||'|42'), id LIMIT 120",
)
ORACLE["contiguous_grid"] = sql(
    "sold AS (SELECT * FROM feat WHERE sales>0)",
    "grid AS (SELECT id, CAST(unnest(range(f, last+1)) AS INTEGER) AS d FROM (SELECT id, min(d) AS f FROM sold GROUP BY id), lastd)",
    "gapped AS (SELECT g.id, g.d, s.sales, s.sell_price, s.price_rel_dept, s.price_pct_change, s.wday, s.snap FROM grid g LEFT JOIN sold s ON s.id=g.id AND s.d=g.d)",
    select="SELECT id, d, coalesce(sales,0) AS sales, "
    + ", ".join(f"round({filled(c)}, 6) AS {c}" for c in ["sell_price", "price_rel_dept", "price_pct_change"])
    + ", " + ", ".join(f"{filled(c)} AS {c}" for c in ["wday", "snap"]) + " FROM gapped",
)
ORACLE["event_codes"] = sql(
    select=f"SELECT id, d, coalesce(n.c,-1) AS event_name_code, coalesce(t.c,-1) AS event_type_code FROM feat LEFT JOIN {EVENT_CODE} n ON n.v=event_name_1 LEFT JOIN {TYPE_CODE} t ON t.v=event_type_1"
)
ORACLE["series_windows"] = sql(
    LATEST,
    f"coded AS (SELECT feat.*, coalesce(n.c,-1) AS event_name_code FROM feat LEFT JOIN {EVENT_CODE} n ON n.v=event_name_1)",
    f"cut AS (SELECT coded.* FROM coded, orig WHERE d>origin-365 AND d<=origin+{H} AND id IN (SELECT id FROM feat, orig WHERE d>origin-365 AND d<=origin))",
    f"grid AS (SELECT id, CAST(unnest(range(f, origin+{H}+1)) AS INTEGER) AS d FROM (SELECT id, min(d) AS f FROM cut GROUP BY id), orig)",
    "gapped AS (SELECT g.id, g.d, c.sales, c.wday, c.month, c.snap, c.event_name_code, c.sell_price, c.price_rel_dept FROM grid g LEFT JOIN cut c ON c.id=g.id AND c.d=g.d)",
    select="SELECT id, d, CASE WHEN d<=(SELECT origin FROM orig) THEN coalesce(sales,0) END AS sales, "
    + ", ".join(f"{filled(c)} AS {c}" for c in ["wday", "month", "snap", "event_name_code"]) + ", "
    + ", ".join(f"round({filled(c)}, 6) AS {c}" for c in ["sell_price", "price_rel_dept"]) + " FROM gapped",
)
ORACLE["feature_sample"] = sql(
    select=f"SELECT id||'_'||d AS record_id, {EVENT_TIME} AS event_time, id, d, sales, lag_7, {r6('sell_price')} FROM feat ORDER BY id, d LIMIT 2000"
)
ORACLE["bias_frame"] = sql(
    select="SELECT CAST(sales>0 AS INTEGER) AS sold, split_part(store_id,'_',1) AS state_id, dept_id, store_id FROM sales_long"
)
ORACLE["asof_features"] = sql(
    select=f"SELECT id, d, sales, lag_7, {r6('rolling_mean_28', 'sell_price')} FROM feat WHERE d<=400 QUALIFY row_number() OVER (PARTITION BY id ORDER BY d DESC)=1"
)
ORACLE["asof_top10"] = sql(
    select=f"SELECT id||'_'||d AS record_id, {EVENT_TIME} AS event_time, id, d, sales FROM feat WHERE {EVENT_TIME} <= '2001-03-01T00:00:00Z' ORDER BY 2 DESC, 1 LIMIT 10"
)

# -- direct table ------------------------------------------------------------------------------------
ORACLE["origins"] = sql(TRAIN, select="SELECT origin FROM orig")
ORACLE["fold_grid"] = sql(
    FOLDS,
    select=f"SELECT origin AS fold_origin, CAST(origin-{H}-{S.origin_stride}*i AS INTEGER) AS train_origin FROM orig, range({S.n_train_origins}) t(i) WHERE origin-{H}-{S.origin_stride}*i>0",
)
ORACLE["holdout_split"] = sql(TRAIN, select="SELECT origin, origin=(SELECT max(origin) FROM orig) AS is_holdout FROM orig")
ORACLE["direct_table"] = sql(
    TRAIN, DIRECT,
    select=f"SELECT {PRED_KEYS}, sales, lag_7, lag_28, {r6(*DYN_DBL)}, wday, month, event_name_1, event_type_1, snap, {r6('sell_price', 'price_rel_dept')} FROM direct",
)

# -- forecasts -----------------------------------------------------------------------------------------
ORACLE["monotone_quantiles"] = sql(RAW_Q, MONO_Q, select=f"SELECT id, d, {r6(*QN)} FROM monoq")
ORACLE["archive_gate"] = sql(
    RAW_Q, MONO_Q, *BATCH,
    select=" UNION ALL ".join([gate("raw", "rawq"), gate("processed", "monoq"), gate("archive", "cat0")]),
)
ORACLE["reassemble"] = sql(LATEST, DIRECT, PRIORS, PRED, select=f"SELECT {PRED_KEYS}, {r6(*QN)} FROM pred")
ORACLE["cold_start_ids"] = sql(fixed_origin(42), COLD, select="SELECT id, n_days FROM cold")
ORACLE["hierarchy_priors"] = sql(
    LATEST, PRIORS,
    select="SELECT origin, store_id, dept_id, " + ", ".join(f"round(qs[{i + 1}], 6) AS {n}" for i, n in enumerate(QN)) + " FROM priors",
)
ORACLE["cold_start_forecasts"] = sql(
    fixed_origin(42), DIRECT, PRIORS, PRED, COLD, CATALOGUE,
    select=f"SELECT {PRED_KEYS}, {r6(*QN)} FROM cat0 WHERE is_cold_start",
)
ORACLE["forecast_catalogue"] = sql(
    fixed_origin(42), DIRECT, PRIORS, PRED, COLD, CATALOGUE,
    select=f"SELECT {PRED_KEYS}, {r6(*QN)}, is_cold_start FROM cat0",
)

# -- backtest and panel -----------------------------------------------------------------------------------
ORACLE["backtest_prior"] = sql(*BACKTEST, select=f"SELECT {PRED_KEYS}, actual, {r6(*QN)} FROM pred")
ORACLE["fold_metrics"] = sql(
    *BACKTEST,
    select=f"SELECT origin AS fold_origin, count(*) AS n_test_rows, round({wape()}, 6) AS wape, round({mean_pin()}, 6) AS mean_pinball FROM pred GROUP BY origin",
)
ORACLE["by_level"] = sql(
    *BACKTEST, HIST, *panel_ctes("pred", "p"), select=f"SELECT level, n_groups, {r6('wape', 'mase', 'rmsse')} FROM lv_p"
)
ORACLE["by_horizon"] = sql(*BACKTEST, select=f"SELECT horizon, round({wape()}, 6) AS wape, {COVERS} FROM pred GROUP BY horizon")
ORACLE["calibration"] = sql(
    *BACKTEST,
    select=" UNION ALL ".join(
        f"SELECT CAST({n / 100} AS DOUBLE) AS nominal_coverage, round({cover(n)}, 6) AS empirical_coverage FROM pred" for n in INTERVALS
    ),
)
ORACLE["panel_headline"] = sql(
    *BACKTEST, HIST, *panel_ctes("pred", "p"),
    select="SELECT (SELECT round(wape,6) FROM lv_p WHERE level='item_store') AS wape_item_store, (SELECT round(wape,6) FROM lv_p WHERE level='total') AS wape_total, "
    f"(SELECT round(avg(rmsse),6) FROM lv_p) AS wrmsse, {COVERS} FROM pred",
)
ORACLE["dollar_weights"] = sql(FOLDS, HIST, *panel_ctes("feat", "p")[:1], select=f"SELECT id, {r6('weight')} FROM dw_p")
ORACLE["compare_models"] = sql(
    *BACKTEST, NAIVE,
    "hist AS (SELECT * FROM feat WHERE d <= (SELECT min(origin) FROM orig) AND id IN (SELECT id FROM naive))",
    "pred2 AS (SELECT * FROM pred WHERE id IN (SELECT id FROM naive))",
    *panel_ctes("pred2", "p"), *panel_ctes("naive", "n"),
    select="SELECT p.level, " + ", ".join(f"round(p.{m},6) AS {m}_prior, round(n.{m},6) AS {m}_naive" for m in ["wape", "mase", "rmsse"])
    + " FROM lv_p p JOIN lv_n n ON n.level=p.level",
)
ORACLE["metric_wape"] = sql(*BACKTEST, select=f"SELECT store_id, round({wape()}, 6) AS wape FROM pred GROUP BY 1")
ORACLE["metric_pinball"] = sql(
    *BACKTEST,
    select="SELECT store_id, " + ", ".join(f"round({pin('actual', n, q)}, 6) AS pinball_{n}" for q, n in zip(Q, QN))
    + f", round({mean_pin()}, 6) AS mean_pinball FROM pred GROUP BY 1",
)
ORACLE["metric_coverage"] = sql(*BACKTEST, select=f"SELECT store_id, {COVERS} FROM pred GROUP BY 1")
SCALES = """sc AS (SELECT id, avg(abs(sales-s7)) AS seasonal_mae, avg(CAST((sales-s1)*(sales-s1) AS DOUBLE)) AS naive_mse FROM (
   SELECT id, sales, lag(sales,7) OVER w AS s7, lag(sales,1) OVER w AS s1 FROM hist WINDOW w AS (PARTITION BY id ORDER BY d)) GROUP BY id)"""
ORACLE["metric_naive_scales"] = sql(FOLDS, HIST, SCALES, select=f"SELECT id, {r6('seasonal_mae', 'naive_mse')} FROM sc")
ORACLE["metric_scaled"] = sql(
    *BACKTEST, HIST, SCALES,
    select="SELECT pred.id, round(CASE WHEN seasonal_mae>0 THEN avg(abs(actual-q50))/seasonal_mae END, 6) AS mase, "
    "round(CASE WHEN naive_mse>0 THEN sqrt(avg((actual-q50)*(actual-q50))/naive_mse) END, 6) AS rmsse FROM pred JOIN sc ON sc.id=pred.id GROUP BY pred.id, seasonal_mae, naive_mse",
)

# -- monitoring ---------------------------------------------------------------------------------------------
ORACLE["operational_summary"] = sql(
    *BATCH,
    select=f"SELECT min({RUN_DATE}) AS run_date, min('o'||origin) AS model_version, min(origin) AS origin, count(*) AS n_forecasts, count(DISTINCT id) AS n_series, "
    "count(DISTINCT CASE WHEN is_cold_start THEN id END) AS n_cold_start_series, count(DISTINCT horizon) AS horizons FROM cat0",
)
ORACLE["score_forecasts"] = sql(
    *BATCH, "joined AS (SELECT c.*, t.sales AS actual FROM cat0 c JOIN feat t ON t.id=c.id AND t.d=c.target_day)",
    select=f"SELECT horizon, count(*) AS n, round({wape()}, 6) AS wape, round({mean_pin()}, 6) AS pinball, {COVERS} FROM joined GROUP BY horizon",
)
ORACLE["psi"] = sql(*drift_ctes(["rolling_mean_28"]), select=f"SELECT {r6('psi')} FROM drift")
ORACLE["feature_drift"] = sql(*drift_ctes(MONITORED_COLS), select=f"SELECT feature, {r6('psi')}, drifted FROM drift")
ORACLE["monitor_summary"] = sql(*SUMMARY, select=f"SELECT {r6('forecast_wape', 'max_psi')}, n_drifted, n_scored, n_series FROM head")
ORACLE["monitor_metrics_long"] = sql(
    *SUMMARY,
    select="SELECT 'ForecastWAPE' AS metric, round(forecast_wape,6) AS value, 'None' AS unit FROM head UNION ALL SELECT 'MaxPSI', round(max_psi,6), 'None' FROM head "
    "UNION ALL SELECT 'DriftedFeatures', CAST(n_drifted AS DOUBLE), 'Count' FROM head",
)
ORACLE["retrain_trigger"] = sql(*SUMMARY, select=f"SELECT {r6('forecast_wape')}, forecast_wape>0.75 AS retrain FROM head")

# -- validation and governance --------------------------------------------------------------------------------
RULES = {
    "id is complete": "count(*) FILTER (WHERE id IS NULL)",
    "d is complete": "count(*) FILTER (WHERE d IS NULL)",
    "sales >= 0": "count(*) FILTER (WHERE NOT coalesce(sales>=0, false))",
    "sell_price > 0": "count(*) FILTER (WHERE NOT coalesce(sell_price>0, false))",
    "d >= 1": "count(*) FILTER (WHERE NOT coalesce(d>=1, false))",
    "d <= 2000": "count(*) FILTER (WHERE NOT coalesce(d<=2000, false))",
}
ORACLE["dq_rules"] = sql(
    select=" UNION ALL ".join(f"SELECT '{k}' AS rule, {v} AS observed, {v}=0 AS passed FROM feat" for k, v in RULES.items())
    + " UNION ALL SELECT 'row count > 100000', count(*), count(*)>100000 FROM feat"
)
ORACLE["validate_sales"] = sql(select="""
SELECT (SELECT count(*) FROM ser) AS n_series, (SELECT CAST(count(*) AS INTEGER) FROM cal) AS n_days,
  CAST(count(*) FILTER (WHERE id IS NULL OR item_id IS NULL OR dept_id IS NULL OR cat_id IS NULL OR store_id IS NULL OR state_id IS NULL) AS BIGINT) AS null_ids,
  (SELECT count(*) FROM (SELECT id FROM ser GROUP BY id HAVING count(*)>1)) AS duplicate_ids,
  count(*) FILTER (WHERE sales IS NULL) AS null_units, count(*) FILTER (WHERE sales<0) AS negative_units,
  round(avg(CASE WHEN sales=0 THEN 1.0 ELSE 0.0 END), 6) AS zero_rate FROM sales_long""")
ORACLE["validate_calendar"] = sql(select="""
SELECT count(*) AS n_days, CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date,
  count(*) FILTER (WHERE step<0) AS unsorted, count(*) FILTER (WHERE step>=0 AND step<>1) AS gaps, count(d)-count(DISTINCT d) AS duplicate_days,
  count(*) FILTER (WHERE snap_even NOT IN (0,1) OR snap_odd NOT IN (0,1)) AS bad_flags
FROM (SELECT *, date_diff('day', lag(date) OVER (ORDER BY d, date), date) AS step FROM cal)""")
ORACLE["validate_prices"] = sql(select="""
SELECT count(*) AS n_rows, count(DISTINCT item_id) AS n_items,
  count(*) FILTER (WHERE store_id IS NULL OR item_id IS NULL OR wm_yr_wk IS NULL OR sell_price IS NULL) AS null_values,
  count(*) FILTER (WHERE sell_price<=0) AS non_positive,
  (SELECT count(*) FROM (SELECT 1 FROM prices GROUP BY store_id,item_id,wm_yr_wk HAVING count(*)>1)) AS duplicate_keys FROM prices""")


def kl_term(p: str, r: str) -> str:
    """One class of a divergence: 0 where its own share is empty, NULL where only the other one is."""
    return f"CASE WHEN {p}=0 THEN 0.0 WHEN {r}>0 THEN {p}*ln({p}/({r})) END"


def kl_sum(*pairs: tuple[str, str]) -> str:
    return "+".join(f"({kl_term(p, r)})" for p, r in pairs)


MID0, MID1 = "(a0+d0)/2", "(a1+d1)/2"
ORACLE["bias_metrics"] = sql(
    "cnt AS (SELECT count(*) FILTER (WHERE split_part(store_id,'_',1)<>'ASIA') AS na, count(*) FILTER (WHERE split_part(store_id,'_',1)='ASIA') AS nd, "
    "count(*) FILTER (WHERE split_part(store_id,'_',1)<>'ASIA' AND sales>0) AS pa, count(*) FILTER (WHERE split_part(store_id,'_',1)='ASIA' AND sales>0) AS pd FROM sales_long)",
    "shr AS (SELECT na, nd, pa/nullif(na,0) AS a1, pd/nullif(nd,0) AS d1, 1-pa/nullif(na,0) AS a0, 1-pd/nullif(nd,0) AS d0 FROM cnt)",
    select=f"""SELECT 'CI' AS metric, round((na-nd)/nullif(na+nd,0),6) AS value FROM shr UNION ALL SELECT 'DPL', round(a1-d1,6) FROM shr
UNION ALL SELECT 'KL', round({kl_sum(('a0', 'd0'), ('a1', 'd1'))},6) FROM shr
UNION ALL SELECT 'JS', round(({kl_sum(('a0', MID0), ('a1', MID1), ('d0', MID0), ('d1', MID1))})/2,6) FROM shr
UNION ALL SELECT 'KS', round(greatest(abs(a0-d0),abs(a1-d1)),6) FROM shr
UNION ALL SELECT 'LP', round(sqrt((a0-d0)*(a0-d0)+(a1-d1)*(a1-d1)),6) FROM shr
UNION ALL SELECT 'TVD', round((abs(a0-d0)+abs(a1-d1))/2,6) FROM shr""",
)
ORACLE["registry_latest"] = sql(
    *REGISTRY,
    select=f"SELECT status, version, created, {r6('wape')} FROM reg QUALIFY row_number() OVER (PARTITION BY status ORDER BY created DESC, version DESC)=1",
)
ORACLE["promote_decision"] = sql(
    *REGISTRY,
    "inc AS (SELECT * FROM reg WHERE status='Approved' ORDER BY created DESC, version DESC LIMIT 1)",
    "can AS (SELECT * FROM reg WHERE status='PendingManualApproval' ORDER BY created DESC, version DESC LIMIT 1)",
    select="SELECT inc.version AS incumbent, round(inc.wape,6) AS incumbent_wape, can.version AS candidate, round(can.wape,6) AS candidate_wape, "
    "CASE WHEN can.version IS NULL THEN false WHEN inc.wape IS NULL THEN true WHEN can.wape IS NULL THEN false ELSE can.wape<=inc.wape END AS promote, "
    "coalesce(can.wape<=0.75, false) AS registrable FROM (SELECT 1) one LEFT JOIN inc ON true LEFT JOIN can ON true",
)
ORACLE["register_gate"] = sql(*REGISTRY, select=f"SELECT created, {r6('wape')}, coalesce(wape<=0.75, false) AS registered FROM reg")
ORACLE["registry_flip"] = sql(
    *REGISTRY,
    "inc AS (SELECT wape FROM reg WHERE status='Approved' ORDER BY created DESC LIMIT 1)",
    select="SELECT version, created, CASE WHEN status='Approved' THEN status WHEN NOT EXISTS (SELECT 1 FROM inc WHERE inc.wape IS NOT NULL) "
    f"OR reg.wape <= (SELECT wape FROM inc) THEN 'Approved' ELSE 'Rejected' END AS status, {r6('wape')} FROM reg",
)
ORACLE["registry_rollback"] = sql(
    *REGISTRY,
    select="SELECT version, created, CASE WHEN status='Approved' AND version=(SELECT max(version) FROM reg WHERE status='Approved') "
    f"THEN 'Rejected' ELSE status END AS status, {r6('wape')} FROM reg",
)
ORACLE["ab_split"] = sql(
    *BACKTEST, NAIVE,
    select=f"SELECT id, origin, horizon, target_day, {r6('q50')}, 'champion' AS variant FROM pred WHERE origin=(SELECT max(origin) FROM orig) AND {BUCKET}>=20 "
    f"UNION ALL SELECT id, origin, horizon, target_day, {r6('q50')}, 'challenger' FROM naive WHERE origin=(SELECT max(origin) FROM orig) AND {BUCKET}<20",
)
ORACLE["shadow_scores"] = sql(
    *BACKTEST, NAIVE,
    select=f"SELECT 'champion' AS variant, true AS served, count(*) AS n, round({wape()},6) AS wape FROM pred WHERE origin=(SELECT max(origin) FROM orig) "
    f"UNION ALL SELECT 'challenger', false, count(*), round({wape()},6) FROM naive WHERE origin=(SELECT max(origin) FROM orig)",
)

# -- exploration ------------------------------------------------------------------------------------------------
ORACLE["eda_scale"] = sql(select="SELECT count(DISTINCT id) AS n_series, count(DISTINCT d) AS n_days, count(*) AS n_rows FROM sales_long")
ORACLE["eda_zero_share"] = sql(select="SELECT round(avg(CASE WHEN sales=0 THEN 1.0 ELSE 0.0 END),6) AS zero_sales_share FROM sales_long")
for _name, _column in [("state", "state_id"), ("store", "store_id"), ("cat", "cat_id"), ("dept", "dept_id")]:
    ORACLE[f"eda_units_{_name}"] = units(_column)
ORACLE["eda_top20"] = units("id", "LIMIT 20")
ORACLE["eda_cardinality"] = sql(
    select=" UNION ALL ".join(f"SELECT '{c}' AS level, count(DISTINCT {c}) AS n FROM sales_long" for c in IDS[1:])
)
ORACLE["eda_zero_hist"] = sql(
    "shares AS (SELECT id, avg(CASE WHEN sales=0 THEN 1.0 ELSE 0.0 END) AS s FROM sales_long GROUP BY id)",
    "ext AS (SELECT min(s) AS lo, max(s) AS hi FROM shares)",
    "hist AS (SELECT CAST(least(floor(coalesce((s-lo)/nullif(hi-lo,0.0),0.0)*50), 49) AS INTEGER) AS bin, count(*) AS n, count(*) FILTER (WHERE s>0.9) AS n90 FROM shares, ext GROUP BY 1)",
    select="SELECT CAST(b AS INTEGER) AS bin, coalesce(n, 0) AS n_series, coalesce(n90, 0) AS n_above_90, "
    "(SELECT round(avg(CASE WHEN s>0.9 THEN 1.0 ELSE 0.0 END), 6) FROM shares) AS share_above_90 FROM range(50) t(b) LEFT JOIN hist ON bin=b",
)
ORACLE["eda_daily_total"] = sql(select="SELECT d, date, CAST(sum(sales) AS BIGINT) AS total_units FROM sales_long GROUP BY 1,2")
ORACLE["eda_weekday_mean"] = sql(
    "tot AS (SELECT d, CAST(sum(sales) AS BIGINT) AS t FROM sales_long GROUP BY 1)",
    select="SELECT weekday, round(avg(t),6) AS mean_units FROM tot JOIN cal USING (d) GROUP BY 1",
)
ORACLE["eda_snap_lift"] = sql(
    "tot AS (SELECT d, snap, CAST(sum(sales) AS BIGINT) AS t FROM sales_long WHERE cat_id='SIZED' AND state_id='ASIA' GROUP BY 1,2)",
    "mn AS (SELECT avg(CASE WHEN snap=1 THEN t END) AS snap_mean, avg(CASE WHEN snap=0 THEN t END) AS other_mean FROM tot)",
    select="SELECT round(snap_mean,6) AS snap_mean, round(other_mean,6) AS other_mean, round(snap_mean/nullif(other_mean,0.0)-1,6) AS lift FROM mn",
)
ORACLE["eda_price_change"] = sql(
    select="SELECT round(avg(CASE WHEN coalesce(price_pct_change,0)<>0 THEN 1.0 ELSE 0.0 END),6) AS changed_share, "
    "round(quantile_cont(CASE WHEN price_pct_change<>0 THEN abs(price_pct_change) END, 0.5),6) AS median_abs_change FROM pf"
)

# -- boosted model: what must hold for any fit ----------------------------------------------------------------
ORACLE["model_roundtrip"] = sql(
    LATEST, DIRECT, select="SELECT count(*) AS n_rows, " + ", ".join(f"CAST(0 AS DOUBLE) AS diff_{n}" for n in QN) + " FROM direct"
)
ORACLE["gate_gbt"] = sql(
    LATEST, DIRECT, select="SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_negative, CAST(0 AS BIGINT) AS n_crossing FROM direct"
)
ORACLE["gbt_start_loss"] = sql(
    TRAIN, DIRECT, f"start AS (SELECT unnest({Q}) AS quantile, unnest(quantile_cont(CAST(sales AS DOUBLE), {Q})) AS v FROM direct)",
    select="SELECT CAST(quantile AS DOUBLE) AS quantile, round(avg(greatest(quantile*(sales-v), (quantile-1)*(sales-v))), 6) AS start_loss, "
    "true AS never_worse FROM start, direct GROUP BY 1",
)
ORACLE["train_gbt_checks"] = sql(
    TRAIN, DIRECT, select=f"SELECT CAST(quantile AS DOUBLE) AS quantile, n AS train_rows, CAST(61 AS BIGINT) AS n_losses, true AS leaves_kept, "
    f"true AS never_rose FROM (SELECT unnest({Q}) AS quantile), (SELECT count(*) AS n FROM direct)",
)
BROKEN = "CAST(0 AS BIGINT) AS n_negative, CAST(0 AS BIGINT) AS n_crossing, count(DISTINCT id) AS n_series"
ORACLE["forecast_gbt_checks"] = sql(
    LATEST, DIRECT, select=f"SELECT horizon, count(*) AS n_rows, {BROKEN}, CAST(0 AS BIGINT) AS n_null, CAST(sum(sales) AS BIGINT) AS units FROM direct GROUP BY horizon",
)
ORACLE["backtest_gbt_checks"] = sql(
    FOLDS, DIRECT, select=f"SELECT origin, count(*) AS n_rows, {BROKEN}, CAST(sum(sales) AS BIGINT) AS units, true AS beats_naive FROM direct GROUP BY origin",
)
# Six candidates; three go on at a quarter of the rounds, two at the half.
ORACLE["tune_holdout_checks"] = sql(
    LATEST, DIRECT, select="SELECT CAST(6 AS BIGINT) AS n_candidates, CAST(6 AS BIGINT) AS n_scored, CAST(2 AS BIGINT) AS n_full, "
    "CAST(1 AS BIGINT) AS n_best, count(*) > 0 AS best_is_least FROM direct",
)

# -- the same statements as SQL text, exports and committed runs --------------------------------------------------
for _sql, _eda in {"scale": "scale", "zero_share": "zero_share", "units_state": "units_state", "units_store": "units_store",
                   "units_cat": "units_cat", "units_dept": "units_dept", "top_series": "top20", "daily_units": "daily_total"}.items():
    ORACLE[f"sql_{_sql}"] = ORACLE[f"eda_{_eda}"]
ORACLE["calendar_export"] = sql(
    select="SELECT strftime(date, '%Y-%m-%d') AS date, 'd_' || d AS d, wm_yr_wk, weekday, wday, month, year FROM cal"
)
ORACLE["panel_artifacts"] = ORACLE["by_level"]
ORACLE["monitor_artifacts"] = ORACLE["score_forecasts"]
