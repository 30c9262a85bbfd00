"""DuckDB SQL for queries built on least squares: a Gram matrix per series is made by grouped
sums and swept column by column in a recursive query (the sweep operator of regression: after
sweeping the regressors, the response column holds the coefficients, the corner the squared
error, and the regressors' block minus their inverse)."""

from __future__ import annotations

from tsforge.plans.oracle import BARS, FEATS, LEVELS_AND_WALK, SQL, W, WALK, _w, autocov, decomposition

SHIFT_LAGS = 30  # Schwert's rule stays below this for the series here (up to about 3,900 rows)


def sweep_step(g: str, k: str, size: int) -> str:
    """Column ``k`` of matrix ``g`` swept; a zero pivot leaves the matrix as it is."""
    return (f"list_transform(range(1, {size + 1}), lambda i: list_transform(range(1, {size + 1}), lambda j: "
            f"case when {g}[{k}][{k}] = 0 then {g}[i][j] when i = {k} and j = {k} then -1.0 / {g}[{k}][{k}] "
            f"when i = {k} or j = {k} then {g}[i][j] / {g}[{k}][{k}] "
            f"else {g}[i][j] - {g}[i][{k}] * {g}[{k}][j] / {g}[{k}][{k}] end))")


def gram_cte(name: str, rows: str, size: int) -> str:
    """``name``: series_id, g = sum of v v' over ``rows`` (series_id, v)."""
    return f"""{name}_c as (select series_id, a, b, sum(v[a] * v[b]) as s
   from {rows}, range(1, {size + 1}) ta(a), range(1, {size + 1}) tb(b) group by all),
{name}_r as (select series_id, a, list(s order by b) as r from {name}_c group by all),
{name} as (select series_id, list(r order by a) as g from {name}_r group by 1)"""


def sweeps_cte(name: str, gram: str, size: int, steps: str) -> str:
    """``name``: series_id, step, g after each of the first ``steps`` columns was swept (``steps``
    is an expression over the columns of ``gram``)."""
    return f"""{name} as (
  select *, 0 as step, {steps} as top from {gram}
  union all
  select * replace ({sweep_step('g', '(step + 1)', size)} as g, step + 1 as step) from {name} where step < top)"""


def norm_cdf(x: str) -> str:
    """Standard normal distribution function by its power series (|x| up to 8)."""
    term = "a.t * x2 / (2 * k + 1)"
    series = f"(list_reduce(range(1, 160), lambda a, k: {{'t': {term.replace('x2', f'({x}) * ({x})')}, 's': a.s + {term.replace('x2', f'({x}) * ({x})')}}}, {{'t': cast({x} as double), 's': cast({x} as double)}})).s"
    return f"case when {x} < -8 then 0.0 when {x} > 8 then 1.0 else 0.5 + exp(-0.5 * ({x}) * ({x})) / sqrt(2 * pi()) * {series} end"


def adf_ctes(src: str) -> str:
    """``adf``: series_id, n, tau, p, used_lag, nobs of the augmented Dickey-Fuller test on ``src``."""
    k = SHIFT_LAGS
    size = k + 3
    return f"""
ad0 as (select series_id, ts, close, count(*) over (partition by series_id) as n, avg(close) over (partition by series_id) as mu,
               stddev_pop(close) over (partition by series_id) as sd, min(close) over (partition by series_id) as lo,
               max(close) over (partition by series_id) as hi from {src} where close is not null),
ad1 as (select series_id, ts, n, case when lo = hi then 0.0 else (close - mu) / sd end as x,
               cast(least(ceil(12.0 * pow(n / 100.0, 0.25)), floor(n / 2) - 2) as integer) as pmax from ad0),
ad2 as (select *, row_number() over ({W}) - 1 as j, lag(x) over ({W}) as xl, x - lag(x) over ({W}) as dx from ad1),
ad3 as (select *, list_reverse(list(dx) over ({W} rows between {k} preceding and 1 preceding)) as back from ad2),
ad4 as (select series_id, j, pmax, list_concat([1.0, xl], list_concat(
          list_transform(range(1, {k + 1}), lambda i: case when i <= pmax then coalesce(back[i], 0.0) else 0.0 end), [dx])) as v
        from ad3 where j >= 1),
adc as (select series_id, v from ad4 where j >= pmax + 1),
{gram_cte('adg', 'adc', size)},
adm as (select distinct series_id, n, pmax from ad1),
adp as (select series_id, g, pmax, g[1][1] as nobs from adg join adm using (series_id) where g[1][1] >= 3 and g[2][2] > 0),
{sweeps_cte('ads', 'adp', size, 'pmax + 2')},
ada as (select series_id, step - 2 as p, nobs * (ln(2 * pi()) + ln(greatest(g[{size}][{size}], 1e-300) / nobs) + 1) + 2 * step as aic
        from ads where step >= 2),
adb as (select series_id, arg_min(p, aic order by p) as p from ada group by 1),
adr as (select series_id, v, p from ad4 join adb using (series_id) where j >= p + 1),
{gram_cte('adh', 'adr', size)},
adq as (select series_id, g, p, g[1][1] as nobs from adh join adb using (series_id)),
{sweeps_cte('adt', 'adq', size, 'p + 2')},
adu as (select series_id, p, nobs, g[2][{size}] / sqrt(g[{size}][{size}] / (nobs - 2 - p) * -g[2][2]) as tau from adt where step = p + 2),
adx as (select *, case when tau <= -1.61 then 2.1659 + 1.4412 * tau + 0.038269 * tau * tau
                       else 1.7339 + 0.93202 * tau - 0.12745 * tau * tau - 0.010368 * tau * tau * tau end as z from adu),
adf as (select series_id, n, tau, case when tau > 2.74 then 1.0 when tau < -18.83 then 0.0 else {norm_cdf('z')} end as p_value,
               p as used_lag, cast(nobs as bigint) as nobs
        from adm left join adx using (series_id))"""


def kpss_ctes(src: str) -> str:
    """``kp``: series_id, n, l, x, p_value of the KPSS test on ``src``; null for a constant series."""
    m = "floor(pow(n, 2.0 / 9))"
    c = [f"(case when {i} <= {m} then s{i} / (n / 2.0) else 0.0 end)" for i in range(1, 41)]
    tail = " + ".join(f"(case when {i} <= l then s{i} * (1.0 - {i} / (l + 1.0)) else 0.0 end)" for i in range(1, 41))
    return autocov(src, 40) + f""",
kc as (select series_id, min(close) = max(close) as same from {src} group by 1),
kb as (select *, s0 / n + (0.0 + {" + ".join(c)}) as h0, (0.0 + {" + ".join(f"{x} * {i}" for i, x in enumerate(c, 1))}) as h1
       from sums join kc using (series_id)),
kl as (select *, case when not same then cast(least(floor(1.1447 * pow(pow(h1 / h0, 2), 1.0 / 3) * pow(n, 1.0 / 3)), n - 1) as integer) end as l from kb),
ks as (select series_id, n, l, case when l is not null then (s0 + 2.0 * (0.0 + {tail})) / n end as sg from kl),
ke as (select series_id, sum(cs * cs) as ss from (
         select series_id, sum(e) over ({W} rows between unbounded preceding and current row) as cs from ec) group by 1),
kx as (select series_id, n, l, ss / (n * n) / sg as x from ks join ke using (series_id)),
kp as (select *, case when x is null then null when x <= 0.347 then 0.10
                      when x <= 0.463 then 0.10 + (x - 0.347) * (0.05 - 0.10) / (0.463 - 0.347)
                      when x <= 0.574 then 0.05 + (x - 0.463) * (0.025 - 0.05) / (0.574 - 0.463)
                      when x <= 0.739 then 0.025 + (x - 0.574) * (0.01 - 0.025) / (0.739 - 0.574)
                      else 0.01 end as p_value from kx)"""


def _rec(*ctes: str) -> str:
    return "with recursive " + ",\n".join(ctes) + "\n"


DIFF_WALK = f"""lwd as (select * from lw union all
  select concat('dwalk|', series_id), ts, d from (select series_id, ts, close - lag(close) over ({W}) as d from walk) where d is not null)"""

SQL["adf"] = _rec(BARS, WALK, LEVELS_AND_WALK, DIFF_WALK, adf_ctes("lwd")) + """
select series_id, n, round(tau, 6) as adf_stat, round(p_value, 6) as adf_pvalue, used_lag, nobs from adf"""

SQL["stationarity_verdict"] = _rec(BARS, WALK, LEVELS_AND_WALK, DIFF_WALK, adf_ctes("lwd"), kpss_ctes("lwd")) + """
select series_id, round(adf.p_value, 6) as adf_pvalue, round(kp.p_value, 6) as kpss_pvalue,
       case when adf.p_value is null or kp.p_value is null then null
            when adf.p_value < 0.05 and kp.p_value > 0.05 then 'stationary' when adf.p_value < 0.05 then 'adf_only'
            when kp.p_value > 0.05 then 'kpss_only' else 'non_stationary' end as verdict
from adf join kp using (series_id)"""

MANY_DIFF = f"""many as (
  select concat(o_orderpriority, '|', c_mktsegment) as series_id, cast(o_orderdate as date) as ts, max_by(o_totalprice, o_orderkey) as close
  from orders join customer on o_custkey = c_custkey group by 1, 2),
md0 as (select series_id, ts, close - lag(close) over ({W}) as close from many),
md as (select * from (select *, count(*) over (partition by series_id) as cnt from md0 where close is not null) where cnt >= 50)"""

SQL["white_noise_gate"] = _rec(MANY_DIFF, adf_ctes("md"), autocov("md", 10)) + """
, lb as (select series_id, case when n > 10 and s0 > 0 then n * (n + 2.0) * (""" + " + ".join(f"pow(s{i} / s0, 2) / (n - {i})" for i in range(1, 11)) + """) end as q from sums)
, lp as (select series_id, exp(-q / 2) * (1 + q / 2 + pow(q / 2, 2) / 2 + pow(q / 2, 3) / 6 + pow(q / 2, 4) / 24) as lb_p from lb)
, sd as (select series_id, stddev_pop(close) as sp from md group by 1)
select series_id, round(adf.p_value, 6) as adf_pvalue, round(lb_p, 6) as lb_pvalue, round(sp, 4) as std_pop,
       not coalesce(adf.p_value > 0.05 and lb_p > 0.05 and sp < 1.0, false) as kept
from adf join lp using (series_id) join sd using (series_id)"""

EDGE = f"""edge as (
  select concat('constant|', series_id) as series_id, cast(ts as timestamp) as ts, cast(7.25 as double) as close from bars
  union all
  select concat('first30|', series_id), cast(ts as timestamp), close from (select *, row_number() over ({W}) as rn from bars) where rn <= 30
  union all
  select concat('events|', event_type), date_trunc('hour', ts), max_by(value, ts) from events group by all)"""

SQL["stationarity_edge"] = _w(BARS, EDGE, kpss_ctes("edge")) + """
select series_id, n, l as kpss_lags, round(x, 8) as kpss_stat, round(p_value, 8) as kpss_pvalue,
       case when x is null then 'constant series' end as kpss_reason from kp"""

LEVEL_DIFF = f"""ld as (select concat('level|', series_id) as series_id, ts, close from bars
  union all
  select concat('diff|', series_id), ts, d from (select series_id, ts, close - lag(close) over ({W}) as d from bars) where d is not null),
ldm as (select series_id, not bool_or(close <= 0) as mult from ld group by 1),
lda as (select * from ld where series_id in (select series_id from ldm where not mult)),
ldb as (select * from ld where series_id in (select series_id from ldm where mult))"""

SQL["decompose_auto"] = "\nunion all\n".join(
    "(" + _w(BARS, LEVEL_DIFF, decomposition(src, mult)) + f"""
select series_id, ts, '{'multiplicative' if mult else 'additive'}' as model, round(observed, 6) as observed,
       round(case when reason is null then trend end, 6) as trend, round(case when reason is null then seasonal end, 6) as seasonal,
       round(case when reason is null then resid end, 6) as resid, reason from dec)""" for src, mult in (("lda", False), ("ldb", True)))

SQL["hash_split_counts"] = _w(BARS) + """
select series_id, split, count(*) as n from (
  select series_id, case when cast(('0x' || substr(md5(concat_ws('|', series_id, cast(ts as varchar), '42')), 1, 8)) as bigint) % 100 < 80
                         then 'train' else 'test' end as split from bars)
group by all"""


# ---- ARIMA(4,0,1) by Hannan-Rissanen: two regressions and a recursion --------------------------------------

def hannan_rissanen(src: str, p: int = 4, long_lags: int = 64, horizon: int = 30) -> str:
    """``hrf``: series_id, horizon, forecast."""
    size1, size2 = long_lags + 2, p + 3
    return f"""
hr0 as (select series_id, ts, close, count(*) over (partition by series_id) as n, avg(close) over (partition by series_id) as mu from {src}),
hr1 as (select series_id, ts, close - mu as x, mu, row_number() over ({W}) as pos,
               cast(least(greatest(floor(pow(ln(n), 2)), {2 * p}), floor((n - 2) / 3.0)) as integer) as m from hr0),
hr2 as (select *, list_reverse(list(x) over ({W} rows between {long_lags} preceding and 1 preceding)) as back from hr1),
hr3 as (select series_id, ts, pos, m, x, back, list_concat([1.0], list_concat(
          list_transform(range(1, {long_lags + 1}), lambda i: case when i <= m then coalesce(back[i], 0.0) else 0.0 end), [x])) as v from hr2),
hrc as (select series_id, v from hr3 where pos > m),
{gram_cte('hrg', 'hrc', size1)},
hrm as (select distinct series_id, m, mu from hr1 where m >= {p + 1}),
hrp as (select series_id, g, m from hrg join hrm using (series_id)),
{sweeps_cte('hrs', 'hrp', size1, 'm + 1')},
hrb as (select series_id, list_transform(range(1, {long_lags + 2}), lambda i: case when i <= m + 1 then g[i][{size1}] else 0.0 end) as coef
        from hrs where step = m + 1),
hre as (select series_id, ts, pos, x, back, case when pos > m then x - list_sum(list_transform(range(1, {long_lags + 2}), lambda i: coef[i] * v[i])) end as e
        from hr3 join hrb using (series_id)),
hrl as (select *, lag(e) over ({W}) as el from hre),
hrv as (select series_id, pos, x, list_concat([1.0], list_concat(back[1:{p}], [el, x])) as v from hrl where el is not null and len(back) >= {p}),
{gram_cte('hrh', 'hrv', size2)},
hrq as (select series_id, g from hrh),
{sweeps_cte('hrt', 'hrq', size2, str(p + 2))},
hrz as (select series_id, list_transform(range(1, {p + 3}), lambda i: g[i][{size2}]) as c from hrt where step = {p + 2}),
hry as (select series_id, arg_max(list_concat([x], v[2:{p}]), pos) as last_x,
               arg_max(x - list_sum(list_transform(range(1, {p + 3}), lambda i: c[i] * v[i])), pos) as last_e, any_value(c) as c
        from hrv join hrz using (series_id) group by 1),
hrr as (select series_id, (list_reduce(range(1, {horizon + 1}), lambda a, h: {{
            'x': list_concat([a.c[1] + {" + ".join(f"a.c[{i + 1}] * a.x[{i}]" for i in range(1, p + 1))} + case when h = 1 then a.c[{p + 2}] * a.e else 0.0 end], a.x),
            'c': a.c, 'e': a.e}}, {{'x': last_x, 'c': c, 'e': last_e}})).x as path from hry),
hrf as (select series_id, cast(h as integer) as horizon, mu + path[{horizon + 1} - h] as forecast
        from hrr join hrm using (series_id), range(1, {horizon + 1}) t(h))"""


HOLDOUT = f"""ho as (select series_id, ts, close, row_number() over ({W}) as pos, count(*) over (partition by series_id) as cnt from walk),
htr as (select series_id, ts, close from ho where pos <= cnt - 30),
hte as (select series_id, ts, close as actual, cast(pos - (cnt - 30) as integer) as horizon from ho where pos > cnt - 30)"""

SQL["arima_hr_forecast"] = _rec(BARS, WALK, HOLDOUT, hannan_rissanen("htr")) + """
select series_id, 'arima_hr' as model, ts, horizon, actual, round(forecast, 4) as forecast from hrf join hte using (series_id, horizon)"""


# ---- VAR on three columns: orders 0..5 by AIC on one sweep, a refit, and the vector recursion ----------------

OPEN_WALK = f"""owalk as (
  select series_id, ts,
         round(1000 + sum((open - mu) / sd) over ({W} rows between unbounded preceding and current row), 6) as open
  from bars join (select series_id, avg(open) as mu, stddev_pop(open) as sd from bars group by 1) using (series_id)),
three as (select series_id, ts, walk.close, owalk.open, cast(volume as double) as volume
          from walk join owalk using (series_id, ts) join (select series_id, ts, volume from bars) using (series_id, ts)),
thn as (select *, row_number() over ({W}) as rn, count(*) over (partition by series_id) as cnt from three),
vtr as (select * from thn where rn <= cnt - 30)"""


def var_ctes(src: str, pmax: int = 5, horizon: int = 30) -> str:
    """``vaf``: series_id, horizon, forecast of ``close`` from a VAR of close, open and volume."""
    m, size = 3, 1 + 3 * pmax + 3
    cols = ("close", "open", "volume")
    lags = ", ".join(f"coalesce(lag(z{j}, {i}) over ({W}), 0.0)" for i in range(1, pmax + 1) for j in range(m))
    y = [1 + m * pmax + 1 + j for j in range(m)]
    s = [[f"(g[{a}][{b}] / t)" for b in y] for a in y]
    det = (f"({s[0][0]} * ({s[1][1]} * {s[2][2]} - {s[1][2]} * {s[2][1]}) - {s[0][1]} * ({s[1][0]} * {s[2][2]} - {s[1][2]} * {s[2][0]})"
           f" + {s[0][2]} * ({s[1][0]} * {s[2][1]} - {s[1][1]} * {s[2][0]}))")
    step = ", ".join(f"(a.b[1][{j + 1}] + coalesce(list_sum(list_transform(range(1, {m} * a.p + 1), lambda i: a.b[i + 1][{j + 1}] * a.h[i])), 0.0))" for j in range(m))
    return f"""
va0 as (select series_id, {", ".join(f"avg({c}) as mu{j}, coalesce(nullif(stddev_pop({c}), 0), 1.0) as sd{j}" for j, c in enumerate(cols))} from {src} group by 1),
va1 as (select series_id, ts, {", ".join(f"({c} - mu{j}) / sd{j} as z{j}" for j, c in enumerate(cols))} from {src} join va0 using (series_id)),
va2 as (select series_id, row_number() over ({W}) as pos, list_value(1.0, {lags}, z0, z1, z2) as v from va1),
vac as (select series_id, v from va2 where pos >= {pmax + 1}),
{gram_cte('vag', 'vac', size)},
vap as (select series_id, g, g[1][1] as t from vag),
{sweeps_cte('vas', 'vap', size, str(1 + m * pmax))},
vaa as (select series_id, (step - 1) / {m} as p, ln({det}) + 2.0 * ((step - 1) / {m} * {m * m} + {m}) / t as aic
        from vas where step >= 1 and (step - 1) % {m} = 0 and t > step + {m}),
vab as (select series_id, cast(arg_min(p, aic order by p) as integer) as p from vaa group by 1),
var as (select series_id, v from va2 join vab using (series_id) where pos >= p + 1),
{gram_cte('vah', 'var', size)},
vaq as (select series_id, g, p from vah join vab using (series_id)),
{sweeps_cte('vat', 'vaq', size, f'1 + {m} * p')},
vaz as (select series_id, p, list_transform(range(1, {size + 1}), lambda i: [{", ".join(f"g[i][{k}]" for k in y)}]) as b
        from vat where step = 1 + {m} * p),
val as (select series_id, arg_max(list_concat(v[{y[0]}:{y[2]}], v[2:{1 + m * pmax}]), pos) as h from va2 group by 1),
vax as (select series_id, (list_reduce(range(1, {horizon + 1}), lambda a, k: {{'h': list_concat([{step}], a.h), 'b': a.b, 'p': a.p}},
                             {{'h': h, 'b': b, 'p': p}})).h as path from vaz join val using (series_id)),
vaf as (select series_id, cast(k as integer) as horizon, mu0 + sd0 * path[{m} * ({horizon} - k) + 1] as forecast
        from vax join va0 using (series_id), range(1, {horizon + 1}) t(k))"""


SQL["var_forecast"] = _rec(BARS, WALK, OPEN_WALK, HOLDOUT, var_ctes("vtr")) + """
select series_id, 'var' as model, ts, horizon, actual, round(forecast, 4) as forecast from vaf join hte using (series_id, horizon)"""

SQL["model_comparison"] = "with fc as (\n" + "\nunion all\n".join(
    f"select series_id, model, ts, horizon, actual, forecast from ({SQL[q]})"
    for q in ("multistep_baselines", "holt_forecast", "arima_hr_forecast", "var_forecast")) + """)
select series_id, model, count(*) as n, round(sqrt(avg((actual - forecast) * (actual - forecast))), 4) as rmse,
       round(avg(abs(actual - forecast)), 4) as mae,
       round(1 - sum((actual - forecast) * (actual - forecast)) / nullif(var_pop(actual) * count(*), 0), 6) as r2,
       round(100 * avg(abs((actual - forecast) / nullif(actual, 0))), 6) as mape,
       round(quantile_cont(abs(actual - forecast), 0.5), 4) as medae
from fc group by 1, 2"""

SQL["multivariate_window_rows"] = _w(BARS, FEATS) + f"""
, bf as (select series_id, ts, close, {", ".join(f"first({c} ignore nulls) over ({W} rows between current row and unbounded following) as {c}" for c in ("sma_5", "sma_20", "ema_10", "rsi_14"))} from feats)
, ln as (select series_id, ts, close as target, {", ".join(f"lag({c}, {20 - j}) over ({W}) as {c}_{j}" for c in ("close", "sma_5", "sma_20", "ema_10", "rsi_14") for j in (0, 19))},
                row_number() over ({W}) as rn, row_number() over (partition by series_id order by ts desc) as back from bf)
select series_id, ts, case when back <= 25 then 'test' else 'train' end as split, round(target, 4) as target,
       {", ".join(f"round({c}_{j}, 4) as {c}_{j}" for c in ("close", "sma_5", "sma_20", "ema_10", "rsi_14") for j in (0, 19))}
from ln where rn > 20"""
