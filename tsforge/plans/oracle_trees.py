"""DuckDB SQL for boosted trees and permutations: histograms by grouped sums, splits by window
functions, and the bijection of row numbers by a recursive query."""

from __future__ import annotations

from tsforge.operators import ranks
from tsforge.plans.oracle import BARS, BASELINES, METRICS_CTE, SQL, W, _w

LAGGED = f"""many as ({SQL['bars_many'].strip()}),
lagged as (select series_id, ts, close,
   lag(open) over ({W}) as x0, lag(high) over ({W}) as x1, lag(low) over ({W}) as x2, cast(lag(volume) over ({W}) as double) as x3,
   {', '.join(f'lag(close, {i}) over ({W}) as x{i + 3}' for i in range(1, 6))},
   case when cast(('0x' || substr(md5(concat_ws('|', series_id, cast(ts as varchar), '42')), 1, 8)) as bigint) % 100 < 80 then 1 else 0 end as train
   from many)"""


def boosted(features: int, rounds: int, eta: float, l2: float, bins: int) -> str:
    """CTEs up to ``p{rounds}`` (id, y, series_id, ts, train, p): ``rounds`` trees of depth two."""
    rows = " and ".join(f"x{i} is not null" for i in range(features))
    out = [LAGGED, f"""d as (select row_number() over (order by series_id, ts) as id, *, close as y,
   [{', '.join(f'x{i}' for i in range(features))}]::double[] as xs from lagged where {rows})""",
           """st as (select count(*) as n, pow(2, floor(log2(max(abs(y)))) + 2 - least(30, 61 - ceil(log2(count(*) + 1)))) as unit from d where train = 1)""",
           """base as (select sum(floor(y / unit + 0.5)) / any_value(n) * any_value(unit) as b from d, st where train = 1)""",
           """long as (select id, train, f, xs[f + 1] as v from d, range(0, """ + str(features) + """) t(f))""",
           """rk as (select f, v, row_number() over (partition by f order by v) - 1 as r, count(*) over (partition by f) as n, max(v) over (partition by f) as top
   from long where train = 1)""",
           f"""cuts as (select f, list(distinct v) as cs from rk where ((r + 1) * {bins}) // n > (r * {bins}) // n and v < top group by 1)""",
           """wide as (select id, list(1 + len(list_filter(cs, lambda c: c < v)) order by f) as bs from long join cuts using (f) group by 1)""",
           "p0 as (select id, y, series_id, ts, train, bs, b as p from d join wide using (id), base)"]
    gain = f"gl * gl / (hl + {l2}) + (ga - gl) * (ga - gl) / (ha - hl + {l2}) - ga * ga / (ha + {l2})"

    def best(level: str, rows_cte: str) -> str:
        """The best split of each node of ``rows_cte`` (id, node, g, bs)."""
        return f"""h{level} as (select node, f, bs[f + 1] as b, sum(g) as g, count(*) as h from {rows_cte}, range(0, {features}) t(f) group by all),
c{level} as (select node, f, b, sum(g) over w * unit as gl, sum(h) over w as hl, sum(g) over (partition by node, f) * unit as ga, sum(h) over (partition by node, f) as ha
   from h{level}, st window w as (partition by node, f order by b)),
b{level} as (select *, row_number() over (partition by node order by {gain} desc, f, b) as place, {gain} as gain
   from c{level} where hl >= 1 and ha - hl >= 1 qualify place = 1 and gain > 0)"""
    for r in range(rounds):
        weight = [f"{eta} * -({g} / ({h} + {l2}))" for g, h in (("gl", "hl"), ("(ga - gl)", "(ha - hl)"))]
        out += [
            f"g{r} as (select id, floor((p - y) / unit + 0.5) as g, bs, 0 as node from p{r}, st where train = 1)",
            best(f"{r}a", f"g{r}"),
            f"""n{r} as (select p{r}.*, case when bs[s.f + 1] <= s.b then 0 else 1 end as node1,
   case when bs[s.f + 1] <= s.b then {weight[0]} else {weight[1]} end as w1 from p{r} cross join b{r}a s)""",
            f"k{r} as (select n.id, g, n.bs, n.node1 as node from n{r} n join g{r} using (id))",
            best(f"{r}b", f"k{r}"),
            f"""p{r + 1} as (select id, y, series_id, ts, train, bs, p + case when s.f is null then w1 when bs[s.f + 1] <= s.b then {weight[0]} else {weight[1]} end as p
   from n{r} n left join b{r}b s on s.node = n.node1)"""]
    return ",\n".join(out)


SQL["boosting"] = _w(boosted(9, 3, 0.3, 1.0, 32)) + "select series_id, ts, round(y, 4) as close, round(p, 4) as prediction from p3 where train = 0"


def bijection(x: str, key: int) -> str:
    """One pass of the network over the digits of ``x`` (base b; columns a and b hold the two sizes)."""
    left, right = f"({x}) // b", f"({x}) % b"
    m, mod = ranks.MULTIPLIERS, ranks.MODULUS

    def mixed(v: str, r: int) -> str:
        t = f"((({v}) % {mod} + 1) * {m[r]} + {key % mod * 40_503 + r}) % {mod}"
        u = f"(xor({t}, ({t}) >> 15) * {m[r - 1]}) % {mod}"
        return f"xor({u}, ({u}) >> 13)"
    steps = []
    for r in range(ranks.ROUNDS):
        src, digit, size = ("y", "l", "a") if r % 2 == 0 else ("l", "y", "b")
        steps.append((digit, f"({digit} + {mixed(src, r)}) % {size}"))
    inner = f"select *, {left} as l, {right} as y from walk"
    for digit, e in steps:
        inner = f"select * replace ({e} as {digit}) from ({inner})"
    return f"select rw, n, a, b, l * b + y as place, false as fresh from ({inner} where fresh or place >= n)"


SQL["permuted_rows"] = "with recursive " + BARS + f""",
num as (select series_id, ts, close, row_number() over (order by series_id, ts) - 1 as rw, count(*) over () as n from bars),
size as (select any_value(n) as n, cast(floor(sqrt(any_value(n) - 1)) as bigint) + 1 as a from num),
walk as (
  select rw, n, a, cast(ceil(n / a) as bigint) as b, rw as place, true as fresh from num join size using (n)
  union all
  {bijection('place', 42)})
select x.series_id, x.ts, x.rw as row, place as source_row, round(y.close, 4) as close
from num x join walk w on w.rw = x.rw and not w.fresh and w.place < w.n join num y on y.rw = w.place"""


# ---- the part of a model's results that does not depend on its arithmetic --------------------------------------

def _split(by: str) -> str:
    return (f"case when cast(('0x' || substr(md5(concat_ws('|', {by}, cast(ts as varchar), '42')), 1, 8)) as bigint) % 100 < 80 then 'train' else 'test' end")


_X = [f"x{i}" for i in range(9)]
for _kind, _name in (("rf", "random_forest"), ("gbt", "gbt")):
    SQL[f"{_name}_rows"] = _w(LAGGED) + f"""
select series_id, '{_kind}_same_day' as model, ts, round(close, 4) as actual, true as has_forecast from lagged where train = 0
union all select series_id, '{_kind}_lagged', ts, round(close, 4), true from lagged where train = 0 and {' and '.join(f'{x} is not null' for x in _X)}"""

SQL["lagged_feature_rows"] = _w(LAGGED) + f"""
select series_id, ts, case when train = 1 then 'train' else 'test' end as split, [{', '.join(f'round({x}, 4)' for x in _X)}] as features, round(close, 4) as close
from lagged where {' and '.join(f'{x} is not null' for x in _X)}"""

SQL["model_roundtrip"] = _w(BARS) + f"""
select series_id, ts, round(close, 4) as close, true as same from (select *, row_number() over ({W}) as pos, {_split('series_id')} as split from bars)
where split = 'test' and pos > 5"""

SQL["mlp_rows"] = _w(BARS) + f"""
select series_id, 'mlp' as model, ts, round(close, 4) as actual, true as has_forecast
from (select *, row_number() over (partition by series_id order by ts desc) as back from bars) where back <= 25"""

SQL["naive_utc"] = """
select event_id, case when event_id % 2 = 0 then ts - interval 2 hour else ts + interval 330 minute end as utc from events"""

SQL["preview_rows"] = _w(BARS) + "select series_id, ts, round(close, 4) as close from bars order by 1, 2 limit 5"

SQL["formatted_metrics"] = _w(BARS, BASELINES, METRICS_CTE) + """
select series_id, model, format('{:,.3f}', rmse) as rmse_text, format('{:,.3f}', mae) as mae_text, format('{:,.6f}', r2) as r2_text,
       format('{:,.4f}', mape) || '%' as mape_text from ("""
SQL["formatted_metrics"] += SQL["forecast_metrics"].split(METRICS_CTE)[1].strip().replace("select series_id, model, n, round(rmse, 4) as rmse, round(mse, 2) as mse, round(mae, 4) as mae, round(r2, 8) as r2,\n       round(mape, 6) as mape,", "select series_id, model, n, rmse, mse, mae, r2,\n       mape,") + ")"

SQL["dropped_rows"] = _w(BARS) + f"""
, f as (select series_id, close - lag(close) over ({W}) as diff, close, row_number() over ({W}) as pos from bars)
select series_id, count(*) as whole, count_if(close > 0 and diff > 0) as positive from f where pos >= 20 group by 1"""

SQL["stream_scoring_rows"] = """
select series_id, ts, target, true as scored from (
  select event_type as series_id, ts, value as target, row_number() over (partition by event_type order by ts, event_id) as pos from events) where pos > 20"""
