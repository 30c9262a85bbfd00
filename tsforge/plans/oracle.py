"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each text runs on the driver's tables registered as views. Column names, types and
rounding match ``plans/catalog.py`` one for one.
"""

from __future__ import annotations

BARS = """bars as (
  select o_orderpriority as series_id, cast(o_orderdate as date) as ts,
         min_by(o_totalprice, o_orderkey) as open, max(o_totalprice) as high,
         min(o_totalprice) as low, max_by(o_totalprice, o_orderkey) as close,
         cast(count(*) as bigint) as volume
  from orders group by 1, 2)"""

W = "partition by series_id order by ts"


def frame(a: int, b: int | None = 0) -> str:
    lo = f"{a} preceding" if a > 0 else "current row"
    hi = "current row" if b == 0 else f"{-b} preceding" if b and b < 0 else f"{b} following"
    return f"({W} rows between {lo} and {hi})"


def sma(k: int, v: str = "close") -> str:
    f = frame(k - 1)
    return f"case when count({v}) over {f} = {k} then avg({v}) over {f} end"


FEATS = f"""feats0 as (
  select series_id, ts, close,
         ln(close / lag(close) over ({W})) as log_return,
         close - lag(close) over ({W}) as d,
         {sma(5)} as sma_5,
         {sma(20)} as sma_20,
         {sma(30)} as roll_mean_30,
         case when count(close) over {frame(29)} = 30 then stddev_samp(close) over {frame(29)} end as roll_std_30,
         list_reduce(list(close) over {frame(199)}, lambda acc, x: acc + (cast(2 as double) / 11) * (x - acc)) as ema_10
  from bars),
feats as (
  select *, case when count(d) over {frame(13)} = 14
                 then avg(case when d is null then null else greatest(d, 0) end) over {frame(13)}
                      / nullif(avg(abs(d)) over {frame(13)}, 0) end as rsi_14
  from feats0)"""

BASELINES = f"""b as (
  select series_id, ts, close,
         lag(close, 1) over ({W}) as naive,
         lag(close, 1) over ({W}) + (lag(close, 1) over ({W}) - lag(close, 30) over ({W})) / cast(29 as double) as drift,
         case when count(close) over {frame(5, -1)} = 5 then avg(close) over {frame(5, -1)} end as mean5,
         row_number() over (partition by series_id order by ts desc) as rn
  from bars),
fc as (
  select series_id, 'naive' as model, ts, cast(31 - rn as integer) as horizon, close as actual, naive as forecast from b where rn <= 30
  union all
  select series_id, 'drift', ts, cast(31 - rn as integer), close, drift from b where rn <= 30
  union all
  select series_id, 'mean5', ts, cast(31 - rn as integer), close, mean5 from b where rn <= 30)"""

METRICS_CTE = """m as (
  select series_id, model, count(*) as n,
         sqrt(avg((actual - forecast) * (actual - forecast))) as rmse,
         avg((actual - forecast) * (actual - forecast)) as mse,
         avg(abs(actual - forecast)) as mae,
         1 - sum((actual - forecast) * (actual - forecast)) / nullif(var_pop(actual) * count(*), 0) as r2,
         100 * avg(abs((actual - forecast) / nullif(actual, 0))) as mape,
         100 * avg(case when actual > 0 and forecast > 0 then abs((actual - forecast) / nullif(actual, 0)) end) as mape_pos,
         quantile_cont(abs(actual - forecast), 0.5) as medae,
         quantile_cont(case when actual > 0 and forecast > 0 then abs(actual - forecast) end, 0.5) as medae_pos,
         avg(case when actual > 0 and forecast > 0 then pow(ln(1 + actual) - ln(1 + forecast), 2) end) as msle
  from fc where actual is not null and forecast is not null group by 1, 2),
lg as (
  select series_id, model, metric, value,
         case when metric = 'r2' then -value else value end as s
  from (unpivot m on rmse, mse, mae, mape, r2, medae, msle into name metric value value)
  where value is not null)"""


def _w(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


SQL: dict[str, str] = {}

SQL["series_summary"] = _w(BARS, FEATS) + """
select series_id, count(*) as n_bars,
       round(avg(log_return), 8) as mean_log_return,
       round(stddev_samp(log_return), 8) as volatility,
       round(max_by(sma_5, ts), 4) as last_sma_5,
       round(max_by(sma_20, ts), 4) as last_sma_20,
       round(max_by(roll_std_30, ts), 4) as last_roll_std_30,
       round(max_by(ema_10, ts), 4) as last_ema_10
from feats group by 1"""

SQL["bars_daily"] = _w(BARS) + "select * from bars"

SQL["bars_many"] = """
select concat(o_orderpriority, '|', c_mktsegment) as series_id, cast(o_orderdate as date) as ts,
       min_by(o_totalprice, o_orderkey) as open, max(o_totalprice) as high,
       min(o_totalprice) as low, max_by(o_totalprice, o_orderkey) as close,
       cast(count(*) as bigint) as volume
from orders join customer on o_custkey = c_custkey group by 1, 2"""

SQL["bars_lineitem"] = """
select l_returnflag as series_id, cast(l_shipdate as date) as ts,
       round(sum(l_extendedprice * (1 - l_discount)), 4) as close,
       cast(sum(l_quantity) as bigint) as volume
from lineitem group by 1, 2"""

SQL["stream_bars"] = SQL["bars_hourly_events"] = """
select event_type as series_id, date_trunc('hour', ts) as ts,
       min_by(value, (ts, event_id)) as open, max(value) as high, min(value) as low, max_by(value, (ts, event_id)) as close,
       cast(count(*) as bigint) as volume
from events group by 1, 2"""

SQL["bars_walk"] = _w(BARS) + f"""
, st as (select series_id, avg(close) as mu, stddev_pop(close) as sd from bars group by 1)
select series_id, ts,
       round(1000 + sum((close - mu) / sd) over ({W} rows between unbounded preceding and current row), 6) as close
from bars join st using (series_id)"""

SQL["extract_series"] = _w(BARS) + "select series_id, ts, open, high, low, close from bars where series_id = '1-URGENT'"

SQL["missing_report"] = _w(BARS, FEATS) + "\n".join([
    "select series_id, cast(count(*) as bigint) as n_rows, '" + c + "' as column, cast(count_if(" + c + " is null) as bigint) as n_null from feats group by 1"
    + ("" if i == 5 else " union all")
    for i, c in enumerate(["close", "log_return", "sma_5", "sma_20", "roll_std_30", "rsi_14"])])

SQL["series_length_gate"] = """
with many as (select concat(o_orderpriority, '|', c_mktsegment) as series_id, cast(o_orderdate as date) as ts
              from orders join customer on o_custkey = c_custkey group by 1, 2),
ev as (select concat('events|', event_type) as series_id, cast(date_trunc('day', ts) as date) as ts from events group by 1, 2),
allb as (select * from many union all select * from ev)
select series_id, count(*) as n_rows, cast(case when count(*) >= 50 then count(*) else 0 end as bigint) as n_kept,
       count(*) >= 50 as passed
from allb group by 1"""

SQL["first_difference"] = _w(BARS) + f"""
select series_id, ts, round(diff, 4) as diff from (
  select series_id, ts, close - lag(close) over ({W}) as diff from bars) where diff is not null"""

SQL["log_returns"] = _w(BARS) + f"select series_id, ts, round(ln(close / lag(close) over ({W})), 8) as log_return from bars"

SQL["pct_change"] = _w(BARS) + f"select series_id, ts, round((close / lag(close) over ({W}) - 1) * 100, 6) as pct_change from bars"

SQL["rolling_mean"] = _w(BARS) + f"""
select series_id, ts, round({sma(5)}, 4) as sma_5, round({sma(20)}, 4) as sma_20, round({sma(30)}, 4) as sma_30 from bars"""

SQL["rolling_std"] = _w(BARS) + f"""
select series_id, ts, round(case when count(close) over {frame(29)} = 30 then stddev_samp(close) over {frame(29)} end, 3) as std_30 from bars"""

SQL["ema10"] = _w(BARS, FEATS) + "select series_id, ts, round(ema_10, 4) as ema_10 from feats"

SQL["rsi14"] = _w(BARS, FEATS) + "select series_id, ts, round(rsi_14, 8) as rsi_14 from feats"

_BF = f"({W} rows between current row and unbounded following)"
SQL["backfill"] = _w(BARS, FEATS) + f"""
select series_id, ts,
       round(first_value(sma_5 ignore nulls) over {_BF}, 4) as sma_5,
       round(first_value(sma_20 ignore nulls) over {_BF}, 4) as sma_20,
       round(first_value(rsi_14 ignore nulls) over {_BF}, 8) as rsi_14
from feats"""

_TAIL = "t as (select *, row_number() over (partition by series_id order by ts desc) <= 30 as is_test from bars)"
SQL["minmax_scale"] = _w(BARS, _TAIL) + """
, p as (select series_id, min(case when not is_test then close end) as vmin, max(case when not is_test then close end) as vmax
        from t group by 1)
select series_id, ts, is_test, round((close - vmin) / nullif(vmax - vmin, 0), 8) as scaled from t join p using (series_id)"""

SQL["minmax_roundtrip"] = _w(BARS) + """
, p as (select series_id, min(close) as vmin, max(close) as vmax from bars group by 1)
select series_id, count(*) as n,
       round(max(abs(((close - vmin) / nullif(vmax - vmin, 0)) * (vmax - vmin) + vmin - close)), 6) as max_abs_err
from bars join p using (series_id) group by 1"""

_SEQ = f"s as (select series_id, ts, list(close) over {frame(20, -1)} as lags, close as target from bars)"
SQL["lag_sequences"] = _w(BARS, _SEQ) + "select series_id, ts, lags, target from s where len(lags) = 20"

SQL["sequence_wide"] = _w(BARS, _SEQ) + "select series_id, ts, target, " + ", ".join(
    f"lags[{j + 1}] as feature_{j}" for j in range(20)) + " from s where len(lags) = 20"

SQL["holdout_tail"] = _w(BARS) + """
select series_id, ts, cast(31 - rn as integer) as horizon, close from (
  select *, row_number() over (partition by series_id order by ts desc) as rn from bars) where rn <= 30"""

SQL["holdout_fraction"] = _w(BARS) + f"""
select series_id, ts,
       case when pos <= floor(floor(n * cast(0.8 as double)) * cast(0.9 as double)) then 'train'
            when pos <= floor(n * cast(0.8 as double)) then 'valid' else 'test' end as split
from (select *, row_number() over ({W}) as pos, count(*) over (partition by series_id) as n from bars)"""

SQL["describe"] = _w(BARS) + """
select series_id, count(close) as count, round(avg(close), 4) as mean, round(stddev_samp(close), 3) as std,
       round(min(close), 4) as min, round(quantile_cont(close, 0.25), 4) as p25, round(quantile_cont(close, 0.5), 4) as p50,
       round(quantile_cont(close, 0.75), 4) as p75, round(max(close), 4) as max
from bars group by 1"""

SQL["histogram"] = _w(BARS) + """
, st as (select series_id, min(close) as lo, max(close) as hi from bars group by 1)
, hb as (select series_id, cast(least(coalesce(floor(((close - lo) / nullif(hi - lo, 0)) * 20), 0), 19) as integer) as bin, count(*) as c
         from bars join st using (series_id) group by all)
, ev as (select series_id, lo, hi, cast(b as integer) as bin from st, range(0, 20) r(b))
select series_id, bin, round(lo + bin * ((hi - lo) / 20), 4) as lo_edge, round(lo + (bin + 1) * ((hi - lo) / 20), 4) as hi_edge,
       coalesce(c, 0) as count
from ev left join hb using (series_id, bin)"""

SQL["kde"] = _w(BARS) + """
, st as (select series_id, min(close) as lo, max(close) as hi, count(close) as n,
                stddev_samp(close) * pow(count(close), -0.2) as h from bars group by 1)
, pts as (select series_id, n, h, g, lo + g * ((hi - lo) / 199) as x from st, range(0, 200) r(g))
select series_id, cast(g as integer) as grid_index, round(x, 2) as x,
       round(sum(exp(-0.5 * ((x - close) / h) * ((x - close) / h))) / (n * h * sqrt(2 * pi())) * 1e6, 6) as density_e6
from pts join bars using (series_id) group by series_id, g, x, n, h"""

SQL["baseline_forecasts"] = _w(BARS, BASELINES) + "select series_id, model, ts, horizon, actual, round(forecast, 4) as forecast from fc"

SQL["forecast_metrics"] = _w(BARS, BASELINES, METRICS_CTE) + """
select series_id, model, n, round(rmse, 4) as rmse, round(mse, 2) as mse, round(mae, 4) as mae, round(r2, 8) as r2,
       round(mape, 6) as mape, round(mape_pos, 6) as mape_pos, round(medae, 4) as medae, round(medae_pos, 4) as medae_pos,
       round(msle, 8) as msle
from m"""

SQL["leaderboard"] = _w(BARS, BASELINES, METRICS_CTE) + """
select series_id, metric, model, cast(rank() over (partition by series_id, metric order by s) as integer) as rank from lg"""

SQL["win_share"] = _w(BARS, BASELINES, METRICS_CTE) + """
select a.series_id, a.model,
       round(sum(case when a.s < b.s then 1.0 when a.s = b.s then 0.5 else 0.0 end) / count(*), 8) as win_share,
       count(distinct a.metric) as n_metrics
from lg a join lg b on a.series_id = b.series_id and a.metric = b.metric and a.model <> b.model
group by 1, 2"""

SQL["best_model"] = _w(BARS, BASELINES, METRICS_CTE) + """
select series_id, model as best_model, round(rmse, 4) as best_rmse from (
  select *, row_number() over (partition by series_id order by rmse, model) as rn from m where rmse is not null) where rn = 1"""

SQL["forecast_union_tail"] = _w(BARS, BASELINES) + """
, u as (
  select series_id, 'naive' as model, ts, close as actual, naive as forecast, cast(null as double) as error from b
  union all select series_id, 'drift', ts, close, drift, close - drift from b
  union all select series_id, 'exp_smoothing_mean5', ts, close, mean5, null from b)
select series_id, model, ts, actual, round(forecast, 4) as forecast, round(error, 4) as error from (
  select *, row_number() over (partition by series_id, model order by ts desc) as rn from u)
where not contains(lower(model), 'exp_smoothing') or rn <= 30"""


# ---- series statistics -------------------------------------------------------------------------

WALK = f"""walk as (
  select series_id, ts,
         round(1000 + sum((close - mu) / sd) over ({W} rows between unbounded preceding and current row), 6) as close
  from bars join (select series_id, avg(close) as mu, stddev_pop(close) as sd from bars group by 1) using (series_id))"""

LEVELS_AND_WALK = """lw as (
  select concat('level|', series_id) as series_id, ts, close from bars
  union all select concat('walk|', series_id), ts, close from walk)"""


def autocov(src: str, k: int) -> str:
    """CTE ``sums``: n, s0..s{k} = sum e_t e_{t-k} of demeaned ``close`` per series of ``src``."""
    lags = ", ".join(f"lag(e, {i}) over ({W}) as l{i}" for i in range(1, k + 1))
    sums = ", ".join(["sum(e * e) as s0"] + [f"coalesce(sum(e * l{i}), 0) as s{i}" for i in range(1, k + 1)])
    return f"""ec as (select series_id, ts, close - avg(close) over (partition by series_id) as e,
                     count(*) over (partition by series_id) as n from {src}),
lg_ as (select series_id, n, e, {lags} from ec),
sums as (select series_id, any_value(n) as n, {sums} from lg_ group by 1)"""


def acf_long(k: int) -> str:
    cols = ", ".join(f"s{i}" for i in range(k + 1))
    return f"""al as (select series_id, n, cast(substr(name, 2) as integer) as lag, sk / base as acf
  from (unpivot (select *, s0 as base from sums) on {cols} into name name value sk))"""


SQL["acf30"] = _w(BARS, WALK, autocov("walk", 30), acf_long(30)) + "select series_id, lag, round(acf, 8) as acf from al"

SQL["acf_bands"] = _w(BARS, WALK, autocov("walk", 40), acf_long(40)) + """
, cum as (select *, coalesce(sum(case when lag >= 1 then acf * acf else 0 end)
                      over (partition by series_id order by lag rows between unbounded preceding and 1 preceding), 0) as c
          from al)
select series_id, lag, round(acf, 8) as acf,
       round(1.959963984540054 * sqrt(case when lag = 0 then 0 when lag = 1 then 1.0 / n else (1 + 2 * c) / n end), 8) as acf_band,
       round(1.959963984540054 / sqrt(n), 8) as pacf_band
from cum"""

SQL["ljung_box"] = _w(BARS, WALK, LEVELS_AND_WALK, autocov("lw", 10)) + """
, q as (select series_id, n, n * (n + 2.0) * (""" + " + ".join(f"pow(s{i} / s0, 2) / (n - {i})" for i in range(1, 11)) + """) as q from sums)
select series_id, n, round(q, 6) as lb_stat,
       round(exp(-q / 2) * (1 + q / 2 + pow(q / 2, 2) / 2 + pow(q / 2, 3) / 6 + pow(q / 2, 4) / 24), 8) as lb_pvalue
from q"""

_M = "floor(pow(n, 2.0 / 9))"
_C = [f"(case when {i} <= {_M} then s{i} / (n / 2.0) else 0.0 end)" for i in range(1, 41)]
SQL["kpss"] = _w(BARS, WALK, LEVELS_AND_WALK, autocov("lw", 40)) + f"""
, bw as (select *, s0 / n + (0.0 + {" + ".join(_C)}) as h0,
                (0.0 + {" + ".join(f"{c} * {i}" for i, c in enumerate(_C, 1))}) as h1
         from sums)
, lags as (select *, cast(least(floor(1.1447 * pow(pow(h1 / h0, 2), 1.0 / 3) * pow(n, 1.0 / 3)), n - 1) as integer) as l from bw)
, sig as (select series_id, n, l,
                 (s0 + 2.0 * (0.0 + {" + ".join(f"(case when {i} <= l then s{i} * (1.0 - {i} / (l + 1.0)) else 0.0 end)" for i in range(1, 41))})) / n as sg
          from lags)
, eta as (select series_id, sum(cs * cs) as ss from (
            select series_id, sum(e) over ({W} rows between unbounded preceding and current row) as cs from ec) group by 1)
, st as (select series_id, n, l, ss / (n * n) / sg as x from sig join eta using (series_id))
select series_id, n, l as kpss_lags, round(x, 8) as kpss_stat,
       round(case when x <= 0.347 then 0.10
                  when x <= 0.463 then 0.10 + (x - 0.347) * (0.05 - 0.10) / (0.463 - 0.347)
                  when x <= 0.574 then 0.05 + (x - 0.463) * (0.025 - 0.05) / (0.574 - 0.463)
                  when x <= 0.739 then 0.025 + (x - 0.574) * (0.01 - 0.025) / (0.739 - 0.574)
                  else 0.01 end, 8) as kpss_pvalue
from st"""


def decomposition(src: str, mult: bool) -> str:
    det = "close / trend" if mult else "close - trend"
    sea = "pa / avg(pa) over (partition by series_id)" if mult else "pa - avg(pa) over (partition by series_id)"
    res = "det / seasonal" if mult else "det - seasonal"
    nonpos = "bool_or(close <= 0)" if mult else "false"
    return f"""dp as (select series_id, ts, close, row_number() over ({W}) - 1 as i from {src}),
dtr as (select *, (sum(close) over ({W} rows between 14 preceding and 14 following)
                   + 0.5 * (lag(close, 15) over ({W}) + lead(close, 15) over ({W}))) / 30.0 as trend from dp),
ddt as (select *, {det} as det, i % 30 as phase from dtr),
dpa as (select series_id, phase, avg(det) as pa from ddt group by 1, 2),
dse as (select series_id, phase, {sea} as seasonal from dpa),
dgt as (select series_id, count(close) as n, {nonpos} as nonpos from {src} group by 1),
dec as (select series_id, ts, close as observed,
               case when n < 60 then 'needs 60 observations' when nonpos then 'multiplicative needs positive values' end as reason,
               trend, seasonal, {res} as resid
        from ddt join dse using (series_id, phase) join dgt using (series_id))"""


SQL["decompose_additive"] = _w(BARS, WALK, decomposition("walk", False)) + """
select series_id, ts, round(observed, 6) as observed, round(case when reason is null then trend end, 8) as trend,
       round(case when reason is null then seasonal end, 8) as seasonal, round(case when reason is null then resid end, 6) as resid, reason
from dec"""

SQL["decompose_multiplicative"] = _w(BARS, WALK, decomposition("walk", True)) + """
select series_id, ts, round(observed, 6) as observed, round(case when reason is null then trend end, 8) as trend,
       round(case when reason is null then seasonal end, 8) as seasonal, round(case when reason is null then resid end, 8) as resid, reason
from dec"""

SQL["decompose_type"] = _w(BARS) + f"""
, u as (select concat('level|', series_id) as series_id, close from bars
        union all
        select concat('diff|', series_id), d from (select series_id, close - lag(close) over ({W}) as d from bars) where d is not null)
select series_id, bool_or(close <= 0) as has_non_positive,
       case when bool_or(close <= 0) then 'additive' else 'multiplicative' end as model
from u group by 1"""

SQL["residual_anomalies"] = _w(BARS, decomposition("bars", False)) + """
, z as (select *, (resid - avg(resid) over (partition by series_id)) / stddev_samp(resid) over (partition by series_id) as z from dec)
select series_id, ts, observed, round(resid, 4) as resid, round(z, 6) as z_score from z where abs(z) > 2.0"""

SQL["stream_lag_windows"] = """
select series_id, ts, lags, target from (
  select event_type as series_id, ts, value as target,
         list(value) over (partition by event_type order by ts rows between 20 preceding and 1 preceding) as lags
  from events) where len(lags) = 20"""

SQL["csv_roundtrip"] = SQL["bars_daily"]

SQL["forecast_files"] = _w(BARS, BASELINES) + """
, u as (
  select series_id, 'naive_forecast' as model, ts, close as actual, naive as forecast from b where mean5 is not null
  union all select series_id, 'exp_smoothing_forecast', ts, close, mean5 from b where mean5 is not null
  union all select series_id, 'drift_forecast', ts, close, drift from b where mean5 is not null)
select series_id, model, ts, actual, round(forecast, 4) as forecast from (
  select *, row_number() over (partition by series_id, model order by ts desc) as rn from u)
where not contains(lower(model), 'exp_smoothing') or rn <= 30"""

SQL["parquet_partitions"] = _w(BARS, BASELINES) + "select series_id, model, ts, horizon, actual, round(forecast, 4) as forecast from fc where model = 'naive'"

SQL["sql_view"] = _w(BARS, BASELINES) + """
select series_id, model, ts, actual, round(forecast, 4) as forecast, round(actual - forecast, 4) as error
from fc order by ts, series_id, model limit 5"""

SQL["metrics_table"] = _w(BARS, BASELINES, METRICS_CTE) + """
select series_id, model as model_name, round(rmse, 4) as rmse, round(mse, 2) as mse, round(mae, 4) as mae,
       round(mape, 6) as mape, round(r2, 8) as r2, round(medae, 4) as medae, round(msle, 8) as msle
from m"""

SQL["holt_grid"] = _w(BARS, WALK) + f"""
, lists as (select series_id, list(close order by ts) as xs, count(*) as n from walk group by 1)
, g as (select cast(round(0.05 * i, 2) as double) as alpha from range(1, 20) t(i))
, h as (select cast(round(0.05 * i, 2) as double) as beta from range(1, 20) t(i))
, runs as (
  select series_id, n, alpha, beta,
         list_reduce(xs, lambda acc, x: {{
             'l': alpha * x + (1 - alpha) * (acc.l + acc.b),
             'b': beta * ((alpha * x + (1 - alpha) * (acc.l + acc.b)) - acc.l) + (1 - beta) * acc.b,
             's': acc.s + (x - acc.l - acc.b) * (x - acc.l - acc.b)}},
             {{'l': xs[1], 'b': cast(0 as double), 's': cast(0 as double)}}) as r
  from lists, g, h)
select series_id, alpha, beta, round(sqrt(r.s / n), 6) as rmse from runs"""

SQL["histogram_auto"] = _w(BARS) + """
, st as (select series_id, min(close) as lo, max(close) as hi, count(close) as n,
                quantile_cont(close, 0.75) - quantile_cont(close, 0.25) as iqr from bars group by 1)
, w as (select *, (hi - lo) / (log2(n) + 1.0) as sw, 2.0 * iqr * pow(n, -1.0 / 3.0) as fw from st)
, nb as (select *, cast(greatest(coalesce(ceil((hi - lo) / nullif(case when fw > 0 then least(fw, sw) else sw end, 0)), 1), 1) as integer) as nb
         from w)
, hb as (select series_id, cast(least(coalesce(floor(((close - lo) / nullif(hi - lo, 0)) * nb), 0), nb - 1) as integer) as bin, count(*) as c
         from bars join nb using (series_id) group by all)
, ev as (select series_id, lo, hi, nb, cast(unnest(range(0, nb)) as integer) as bin from nb)
select series_id, bin, round(lo + bin * ((hi - lo) / nb), 4) as lo_edge, round(lo + (bin + 1) * ((hi - lo) / nb), 4) as hi_edge,
       coalesce(c, 0) as count
from ev left join hb using (series_id, bin)"""


def _dl_sum(k: str = "k") -> str:
    return f"coalesce(list_sum(list_transform(acc.phi, lambda y, i: y * gam[{k} - i + 1])), 0)"


def durbin_levinson(kmax: int) -> str:
    """list_reduce over lags 1..kmax: partial autocorrelations (out), AR coefficients (phi) and
    innovation variance (v) from the autocovariance list ``gam`` (gam[1] = gamma_0)."""
    a = f"((gam[k + 1] - {_dl_sum()}) / acc.v)"
    return f"""list_reduce(range(1, {kmax + 1}), lambda acc, k: {{
        'phi': list_concat(list_transform(acc.phi, lambda x, j: x - {a} * acc.phi[k - j]), [{a}]),
        'v': acc.v * (1 - pow({a}, 2)),
        'out': list_append(acc.out, {a})}},
      {{'phi': []::double[], 'v': gam[1], 'out': [cast(1 as double)]}})"""


def _gam(k: int) -> str:
    return "[" + ", ".join(f"s{i} / (n - {i})" for i in range(k + 1)) + "]"


SQL["pacf30"] = _w(BARS, WALK, autocov("walk", 30)) + f"""
, dl as (select series_id, {durbin_levinson(30)} as r from (select series_id, {_gam(30)} as gam from sums))
select series_id, cast(lag - 1 as integer) as lag, round(pacf, 8) as pacf
from (select series_id, unnest(r.out) as pacf, generate_subscripts(r.out, 1) as lag from dl)"""

SQL["yule_walker4"] = _w(BARS, WALK) + f"""
, dw as (select * from (select series_id, ts, close - lag(close) over ({W}) as close from walk) where close is not null)
, {autocov("dw", 4)}
, dl as (select series_id, n, {durbin_levinson(4)} as r from (select series_id, n, {_gam(4)} as gam from sums))
select series_id, n, list_transform(r.phi, lambda x: round(x, 8)) as ar_coef, round(r.v, 8) as sigma2,
       round(sqrt(r.v), 8) as sigma
from dl"""

_TRAIN = "tr as (select * from (select *, row_number() over (partition by series_id order by ts desc) as rn from bars) where rn > 30)"
SQL["garch_variance"] = _w(BARS, _TRAIN) + f"""
, ret as (select * from (select series_id, ts, (close / lag(close) over ({W}) - 1.0) * 100.0 as r from tr) where r is not null)
, mom as (select series_id, avg(r) as mu from ret group by 1)
, eps as (select series_id, ts, r - mu as e from ret join mom using (series_id))
, st as (select series_id, avg(e * e) as s2, count(*) as n, list(e order by ts) as es from eps group by 1)
, ga as (select cast(0.01 as double) as alpha union all select cast(round(0.05 * i, 10) as double) from range(1, 20) t(i))
, gb as (select cast(round(0.05 * i, 10) as double) as beta from range(0, 20) t(i) union all select cast(0.98 as double))
, r1 as (select series_id, alpha, beta, list_reduce(es, lambda acc, e: {{
             'v': case when acc.v is null then s2 else beta * acc.v + s2 * (1 - alpha - beta) + alpha * acc.pe * acc.pe end,
             'll': acc.ll - 0.5 * (ln(2 * pi()) + ln(case when acc.v is null then s2 else beta * acc.v + s2 * (1 - alpha - beta) + alpha * acc.pe * acc.pe end)
                                   + e * e / case when acc.v is null then s2 else beta * acc.v + s2 * (1 - alpha - beta) + alpha * acc.pe * acc.pe end),
             'pe': e}},
             {{'v': cast(null as double), 'll': cast(0 as double), 'pe': cast(null as double)}}) as res
         from st, ga, gb where n >= 10 and s2 > 0 and alpha + beta < 0.9995)
, c1 as (select series_id, arg_max(struct_pack(a := alpha, b := beta), res.ll) as c from r1 group by 1)
, g2 as (select distinct series_id, greatest(round(c.a + 0.005 * i, 10), 0.005) as alpha, greatest(round(c.b + 0.005 * j, 10), 0.0) as beta
         from c1, range(-10, 11) x(i), range(-10, 11) y(j))
, runs as (select series_id, s2, alpha, beta, es[len(es)] as last_e, list_reduce(es, lambda acc, e: {{
             'v': case when acc.v is null then s2 else beta * acc.v + s2 * (1 - alpha - beta) + alpha * acc.pe * acc.pe end,
             'll': acc.ll - 0.5 * (ln(2 * pi()) + ln(case when acc.v is null then s2 else beta * acc.v + s2 * (1 - alpha - beta) + alpha * acc.pe * acc.pe end)
                                   + e * e / case when acc.v is null then s2 else beta * acc.v + s2 * (1 - alpha - beta) + alpha * acc.pe * acc.pe end),
             'pe': e}},
             {{'v': cast(null as double), 'll': cast(0 as double), 'pe': cast(null as double)}}) as res
           from st join g2 using (series_id) where alpha + beta < 0.9995)
, best as (select series_id, arg_max(struct_pack(s2 := s2, a := alpha, b := beta, v := res.v, e := last_e), res.ll) as p from runs group by 1)
, one as (select series_id, p.s2 as s2, p.a as a, p.b as b,
                 p.s2 * (1 - p.a - p.b) + p.a * p.e * p.e + p.b * p.v as v1 from best)
select series_id, cast(h as integer) as horizon, round(s2 + pow(a + b, h - 1) * (v1 - s2), 2) as variance,
       round(sqrt(s2 + pow(a + b, h - 1) * (v1 - s2)), 4) as volatility
from one, range(1, 31) t(h)"""


def _holt_step(a: str, b: str) -> str:
    """One step of three Holt recursions started from (0,0), (1,0), (0,1), accumulating the
    sums that make the SSE a quadratic in the start state (d_k = e_0 - e_k)."""
    def e(k):
        return f"(x - acc.l{k} - acc.t{k})"

    def lv(k):
        return f"({a} * x + (1 - {a}) * (acc.l{k} + acc.t{k}))"
    d1, d2 = f"({e(0)} - {e(1)})", f"({e(0)} - {e(2)})"
    parts = []
    for k in range(3):
        parts.append(f"'l{k}': {lv(k)}")
        parts.append(f"'t{k}': {b} * ({lv(k)} - acc.l{k}) + (1 - {b}) * acc.t{k}")
    parts += [f"'s00': acc.s00 + {e(0)} * {e(0)}", f"'s01': acc.s01 + {e(0)} * {d1}", f"'s02': acc.s02 + {e(0)} * {d2}",
              f"'s11': acc.s11 + {d1} * {d1}", f"'s12': acc.s12 + {d1} * {d2}", f"'s22': acc.s22 + {d2} * {d2}"]
    init = ", ".join([f"'l{k}': cast({1 if k == 1 else 0} as double), 't{k}': cast({1 if k == 2 else 0} as double)" for k in range(3)]
                     + [f"'{s}': cast(0 as double)" for s in ("s00", "s01", "s02", "s11", "s12", "s22")])
    return f"list_reduce(xs, lambda acc, x: {{{', '.join(parts)}}}, {{{init}}})"


def _holt_fit_sql(grid_cte: str) -> str:
    """SSE-optimal start state per candidate (2x2 solve), SSE and final state."""
    return f"""(select series_id, alpha, beta, r,
        (r.s22 * r.s01 - r.s12 * r.s02) / (r.s11 * r.s22 - r.s12 * r.s12) as z1,
        (r.s11 * r.s02 - r.s12 * r.s01) / (r.s11 * r.s22 - r.s12 * r.s12) as z2
      from (select series_id, alpha, beta, {_holt_step("alpha", "beta")} as r from lists, {grid_cte}))"""


SQL["holt_forecast"] = _w(BARS, WALK) + f"""
, tr as (select * from (select *, row_number() over (partition by series_id order by ts desc) as rn from walk) where rn > 30)
, te as (select series_id, ts, cast(31 - rn as integer) as horizon, close as actual
         from (select *, row_number() over (partition by series_id order by ts desc) as rn from walk) where rn <= 30)
, lists as (select series_id, list(close order by ts) as xs from tr group by 1)
, g1 as (select cast(round(0.05 * i, 10) as double) as alpha, cast(round(0.05 * j, 10) as double) as beta
         from range(1, 20) a(i), range(1, 20) b(j))
, f1 as (select *, r.s00 - (r.s01 * z1 + r.s02 * z2) as sse from {_holt_fit_sql("g1")})
, c1 as (select series_id, arg_min(struct_pack(a := alpha, b := beta), sse) as c from f1 group by 1)
, g2 as (select series_id,
                greatest(least(round(c.a - 0.05 + 0.005 * i, 10), 0.999), 0.001) as alpha,
                greatest(least(round(c.b - 0.05 + 0.005 * j, 10), 0.999), 0.001) as beta
         from c1, range(0, 21) a(i), range(0, 21) b(j))
, f2 as (select * , r.s00 - (r.s01 * z1 + r.s02 * z2) as sse from (
           select l.series_id, g2.alpha, g2.beta, {_holt_step("g2.alpha", "g2.beta")} as r
           from lists l join g2 using (series_id)) q,
         lateral (select (r.s22 * r.s01 - r.s12 * r.s02) / (r.s11 * r.s22 - r.s12 * r.s12) as z1,
                         (r.s11 * r.s02 - r.s12 * r.s01) / (r.s11 * r.s22 - r.s12 * r.s12) as z2))
, b2 as (select series_id, arg_min(struct_pack(r := r, z1 := z1, z2 := z2), sse) as p from f2 group by 1)
, fin as (select series_id,
                 p.r.l0 + (p.r.l1 - p.r.l0) * p.z1 + (p.r.l2 - p.r.l0) * p.z2 as lvl,
                 p.r.t0 + (p.r.t1 - p.r.t0) * p.z1 + (p.r.t2 - p.r.t0) * p.z2 as trd
          from b2)
select series_id, 'holt' as model, ts, horizon, actual, round(lvl + horizon * trd, 4) as forecast
from te join fin using (series_id)"""

SQL["multistep_baselines"] = _w(BARS, WALK) + """
, ranked as (select *, row_number() over (partition by series_id order by ts desc) as rn from walk)
, tr as (select * from ranked where rn > 30)
, te as (select series_id, ts, cast(31 - rn as integer) as horizon, close as actual from ranked where rn <= 30)
, st as (select series_id, max_by(close, ts) as last, min_by(close, ts) as first, count(*) as n from tr group by 1)
, fc as (select series_id, 'naive' as model, cast(h as integer) as horizon, last as forecast from st, range(1, 31) t(h)
         union all
         select series_id, 'drift', cast(h as integer), last + h * ((last - first) / (n - 1)) from st, range(1, 31) t(h))
select series_id, model, ts, horizon, actual, round(forecast, 4) as forecast from fc join te using (series_id, horizon)"""

SQL["pacf40_mle"] = _w(BARS, WALK, autocov("walk", 40)) + f"""
, dl as (select series_id, {durbin_levinson(40)} as r from (select series_id, [{", ".join(f"s{i} / n" for i in range(41))}] as gam from sums))
select series_id, cast(lag - 1 as integer) as lag, round(pacf, 8) as pacf
from (select series_id, unnest(r.out) as pacf, generate_subscripts(r.out, 1) as lag from dl)"""

SQL["extract_series_csv"] = SQL["extract_series"]

SQL["distinct_series"] = "select distinct concat(o_orderpriority, '|', c_mktsegment) as series_id from orders join customer on o_custkey = c_custkey"

SQL["std_pop"] = f"""
with many as (select concat(o_orderpriority, '|', c_mktsegment) as series_id, cast(o_orderdate as date) as ts,
                     max_by(o_totalprice, o_orderkey) as close
              from orders join customer on o_custkey = c_custkey group by 1, 2),
d as (select series_id, close - lag(close) over ({W}) as diff from many)
select series_id, round(stddev_pop(diff), 4) as std_pop from d where diff is not null group by 1"""

SQL["forecast_selection"] = _w(BARS, BASELINES) + """
select series_id, model, ts, actual, round(forecast, 4) as forecast, round(actual - forecast, 4) as error,
       round(abs(actual - forecast), 4) as abs_error
from fc where model in ('naive', 'mean5')"""


# the same results from the stored layout
for _name in ("rolling_mean", "backfill", "acf30", "kpss"):
    SQL[f"stored_{_name}"] = SQL[_name]
SQL["stored_decompose"] = SQL["decompose_additive"]

# Marked bars: infinite and missing values apart, an outlier, a constant series.
EDGE = """fst as (select series_id, min(ts) as f from bars group by 1),
edge as (select series_id, ts, case when ts = f and series_id = '1-URGENT' then 1 when ts = f and series_id = '2-HIGH' then -1 else 0 end as inf,
                case when series_id = '3-MEDIUM' and day(ts) % 5 = 0 then null when series_id = '5-LOW' then 7.25
                     when ts = f and series_id = '4-NOT SPECIFIED' then 1e12 when ts = f and series_id in ('1-URGENT', '2-HIGH') then null
                     else close end as v from bars join fst using (series_id)),
-- ranks with the infinite values at the ends
ranked as (select *, row_number() over (partition by series_id order by inf, v) - 1 as rk from edge where inf <> 0 or v is not null),
cnt as (select series_id, count(*) as n, count(v) as nf, min(inf) as low, max(inf) as high, avg(v) as mean, stddev_samp(v) as std, min(v) as lo, max(v) as hi
        from ranked group by 1),
qs as (select series_id, p, max(case when rk = floor((n - 1) * p) then v end) as a, max(case when rk = ceil((n - 1) * p) then v end) as b, any_value((n - 1) * p % 1) as fr
       from ranked join cnt using (series_id) cross join (select unnest([0.25::double, 0.5, 0.75]) as p) group by 1, 2)"""

SQL["describe_edge"] = _w(BARS, EDGE) + """
select series_id, n as count, case when n = nf then round(mean, 2) end as mean, case when n = nf then round(std, 1) end as std,
       case when low = 0 then round(lo, 4) end as min, case when high = 0 then round(hi, 4) end as max,
       round(max(case when p = 0.25 then a + fr * (b - a) end), 4) as p25, round(max(case when p = 0.5 then a + fr * (b - a) end), 4) as p50,
       round(max(case when p = 0.75 then a + fr * (b - a) end), 4) as p75,
       cast(case when low <> 0 then -1 end as integer) as low, cast(case when high <> 0 then 1 end as integer) as high
from cnt join qs using (series_id) group by all"""

SQL["histogram_edge"] = _w(BARS, EDGE) + """
, iqr as (select series_id, max(case when p = 0.75 then a + fr * (b - a) end) - max(case when p = 0.25 then a + fr * (b - a) end) as iqr from qs group by 1)
, w as (select *, (hi - lo) / (log2(n) + 1.0) as sw, 2.0 * iqr * pow(n, -1.0 / 3.0) as fw from cnt join iqr using (series_id))
, nb as (select *, greatest(coalesce(ceil((hi - lo) / nullif(case when fw > 0 then least(fw, sw) else sw end, 0)), 1), 1) as want from w)
, ok as (select *, cast(want as integer) as nb from nb where n = nf and want <= 100000)
, hb as (select series_id, cast(least(coalesce(floor(((v - lo) / nullif(hi - lo, 0)) * nb), 0), nb - 1) as integer) as bin, count(*) as c
         from ranked join ok using (series_id) group by all)
, ev as (select series_id, lo, hi, nb, cast(unnest(range(0, nb)) as integer) as bin from ok)
select series_id, bin, round(lo + bin * ((hi - lo) / nb), 4) as lo_edge, round(lo + (bin + 1) * ((hi - lo) / nb), 4) as hi_edge, coalesce(c, 0) as count,
       null::varchar as reason from ev left join hb using (series_id, bin)
union all select series_id, null, case when low = 0 then round(lo, 4) end, case when high = 0 then round(hi, 4) end, n,
       case when n <> nf then 'infinite value' else 'more than 100000 bins' end from nb where n <> nf or want > 100000"""

# and from statistics kept up to date append by append
for _name in ("ljung_box", "kpss", "describe"):
    SQL[f"live_{_name}"] = SQL[_name]
