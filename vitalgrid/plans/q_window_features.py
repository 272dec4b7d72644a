"""Feature families of windows: autoregression, entropies, spectra, unit root, drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalgrid.operators import window_features as WF
from vitalgrid.plans.q_features import WINS, digits_sql, to_digits, windows
from vitalgrid.plans.registry import query, rounded, sr
from vitalgrid.schema import KEYS
from vitalgrid.session import stored

KEY = "user_id, metric, win"
ORDER = 4


def _digits(columns) -> str:
    return ", ".join(f"{sr(f'cast({digits_sql(c)} as double)', 6)} as {c}" for c in columns)


def _six(df, *names):
    """Six significant digits, as the check SQL has them."""
    return rounded(to_digits(df, names), *names, n=6)


def _levinson_sql(order: int) -> str:
    """The recursion unrolled: CTEs ending in ``l<order>`` with ``a<order>_<j>`` and ``k<h>``."""
    lags = ", ".join(f"sum(c * n{h}) / {30 - h} as r{h}" for h in range(1, order + 1))
    out = f"""c as (select *, y - avg(y) over (partition by {KEY}) as c from wins),
  n as (select *, {", ".join(f"lead(c, {h}) over (partition by {KEY} order by t) as n{h}" for h in range(1, order + 1))} from c),
  l0 as (select {KEY}, sum(c * c) / 30 as r0, {lags}, r0 as v0 from n group by {KEY})"""
    for h in range(1, order + 1):
        known = " + ".join([f"a{h - 1}_{j} * r{h - j}" for j in range(1, h)]) or "0"
        out += f""", l{h}_ as (select *, case when abs(v{h - 1}) > 1e-12 * r0 then (r{h} - ({known})) / v{h - 1} end as k{h} from l{h - 1}),
  l{h} as (select *, v{h - 1} * (1 - k{h} * k{h}) as v{h}, k{h} as a{h}_{h}{"".join(f", a{h - 1}_{j} - k{h} * a{h - 1}_{h - j} as a{h}_{j}" for j in range(1, h))} from l{h}_)"""
    return out


AR = [f"ar_{h}" for h in range(1, ORDER + 1)] + [f"pacf_{h}" for h in range(1, ORDER + 1)]


@query("j2_autoregression", f"""with {WINS}, {_levinson_sql(ORDER)}, x as (select {KEY}, {", ".join(f"a{ORDER}_{h} as ar_{h}, k{h} as pacf_{h}" for h in range(1, ORDER + 1))}
  from l{ORDER}) select {KEY}, {_digits(AR)} from x""")
def j2_autoregression(spark, sf):
    """Autoregression coefficients and partial autocorrelations of each window."""
    return _six(WF.autoregression(windows(spark, sf), ORDER), *AR)


def _order_sql(k: int) -> str:
    bits = " + ".join(f"({'y' if a == 0 else f'y{a}'} <= y{b})::int * {1 << i}"
                      for i, (a, b) in enumerate((a, b) for a in range(k) for b in range(a + 1, k)))
    return f"""o{k} as (select {KEY}, {bits} as code from nx where y{k - 1} is not null),
  pe{k} as (select {KEY}, -sum(p * ln(p)) + 0.0 as permutation_entropy_{k} from (select {KEY}, count(*) / sum(count(*)) over (partition by {KEY}) as p
    from o{k} group by {KEY}, code) group by {KEY})"""


ENTROPIES = ["sample_entropy", "approximate_entropy", "binned_entropy", *[f"permutation_entropy_{k}" for k in WF.ORDERS]]


@query("j2_entropies", f"""with {WINS},
  nx as (select *, 0.2 * (1 + 1e-9) * stddev_pop(y) over w as tol, min(y) over w as low, max(y) over w as high,
    {", ".join(f"lead(y, {h}) over (w order by t) as y{h}" for h in range(1, 5))} from wins window w as (partition by {KEY})),
  m as (select a.user_id, a.metric, a.win, a.t, count(*) as two, count(*) filter (where abs(a.y2 - b.y2) <= a.tol) as three, max(a.y2) as y2
    from nx a join nx b on a.user_id = b.user_id and a.metric = b.metric and a.win = b.win and abs(a.y - b.y) <= a.tol and abs(a.y1 - b.y1) <= a.tol group by all),
  s as (select {KEY}, sum(two - 1) as b, sum(three - 1) filter (where y2 is not null) as a,
    abs(avg(ln(two)) - ln(count(*)) - (avg(ln(three)) filter (where y2 is not null) - ln(count(y2)))) as approximate_entropy from m group by {KEY}),
  bins as (select {KEY}, -sum(p * ln(p)) + 0.0 as binned_entropy from (select {KEY}, count(*) / sum(count(*)) over (partition by {KEY}) as p from
    (select {KEY}, case when high > low then least(floor((y - low) / (high - low) * 10), 9) else 0 end as bin from nx) group by {KEY}, bin) group by {KEY}),
  {_order_sql(3)}, {_order_sql(5)},
  x as (select {KEY}, case when a > 0 and b > 0 then -ln(a / b) end as sample_entropy, * exclude ({KEY}, a, b)
    from s join bins using ({KEY}) join pe3 using ({KEY}) join pe5 using ({KEY}))
  select {KEY}, {_digits(ENTROPIES)} from x""")
def j2_entropies(spark, sf):
    """Sample, approximate, binned and permutation entropy of each window."""
    return _six(WF.entropies(windows(spark, sf)), *ENTROPIES)


MOMENTS = [f"spectral_{c}" for c in ("centroid", "variance", "skew", "kurtosis")]
SPECTRAL = [*MOMENTS, *[f"welch_density_{k}" for k in WF.DENSITIES], "fft_abs_4", "fft_abs_15"]


@query("j2_spectral", f"""with {WINS},
  w as (select *, avg(y) over (partition by {KEY}) as mu, 0.5 - 0.5 * cos(2 * pi() * t / 30) as hann from wins),
  f as (select {KEY}, k, sqrt(pow(sum(y * cos(2 * pi() * k * t / 30)), 2) + pow(sum(y * sin(2 * pi() * k * t / 30)), 2)) as a,
    (pow(sum((y - mu) * hann * cos(2 * pi() * k * t / 30)), 2) + pow(sum((y - mu) * hann * sin(2 * pi() * k * t / 30)), 2)) / sum(hann * hann)
      * case when k between 1 and 14 then 2 else 1 end as p
    from w, (select unnest(generate_series(0, 15)) as k) group by {KEY}, k),
  g as (select {KEY}, sum(a * k) / sum(a) as c, sum(a * k * k) / sum(a) as m2, sum(a * k * k * k) / sum(a) as m3, sum(a * k * k * k * k) / sum(a) as m4,
    {", ".join(f"max(p) filter (where k = {k}) as welch_density_{k}" for k in WF.DENSITIES)}, max(a) filter (where k = 4) as fft_abs_4,
    max(a) filter (where k = 15) as fft_abs_15 from f group by {KEY}),
  x as (select *, c as spectral_centroid, m2 - c * c as spectral_variance,
    case when spectral_variance >= 0.5 then (m3 - 3 * c * spectral_variance - c * c * c) / pow(spectral_variance, 1.5) end as spectral_skew,
    case when spectral_variance >= 0.5 then (m4 - 4 * c * m3 + 6 * m2 * c * c - 3 * pow(c, 4)) / pow(spectral_variance, 2) end as spectral_kurtosis from g)
  select {KEY}, {_digits(SPECTRAL)} from x""")
def j2_spectral(spark, sf):
    """Spectral moments, density and magnitudes of each window."""
    s = WF.spectral(windows(spark, sf))
    s = s.withColumns({f"fft_abs_{k}": F.get("fft_abs", F.lit(k)) for k in (4, 15)}).drop("fft_abs")
    return _six(stored(s, "spectra"), *SPECTRAL)


STANDARD = f"""sd as (select *, avg(y) over (partition by {KEY}) as mu, stddev_pop(y) over (partition by {KEY}) as dev from wins),
  z as (select *, case when dev > 0 then (y - mu) / dev end as z from sd)"""


@query("j2_unit_root", f"""with {WINS}, {STANDARD},
  d as (select *, lag(z) over (partition by {KEY} order by t) as level, z - level as step from z),
  e as (select *, lag(step) over (partition by {KEY} order by t) as step1 from d),
  f as (select {KEY}, level, step, step1, count(*) over w as n, avg(step1) over w as m1, avg(level) over w as ml, avg(step) over w as ms,
    regr_slope(level, step1) over w as sl, regr_slope(step, step1) over w as ss from e where step1 is not null window w as (partition by {KEY})),
  g as (select *, level - ml - sl * (step1 - m1) as rx, step - ms - ss * (step1 - m1) as ry from f),
  h as (select {KEY}, max(n) as n, sum(rx * ry) / sum(rx * rx) as slope, sum(rx * rx) as xx, sum(ry * ry) as yy, sum(level * level) as ll, sum(step * step) as tt from g group by {KEY}),
  x as (select {KEY}, case when xx > 1e-10 * ll then slope end as adf_level,
    case when xx > 1e-10 * ll and yy - slope * slope * xx > 1e-12 * tt then slope * sqrt(xx) / sqrt((yy - slope * slope * xx) / (n - 3)) end as adf_t from h)
  select w.*, {_digits(["adf_t", "adf_level"])} from (select distinct {KEY} from wins) w left join x using ({KEY})""")
def j2_unit_root(spark, sf):
    """Augmented Dickey-Fuller statistic of each window."""
    return _six(WF.unit_root(stored(windows(spark, sf), "windows")), "adf_t", "adf_level").select(*KEYS, "win", "adf_t", "adf_level")


def _eliminate_sql(source: str, k: int) -> str:
    """Gaussian elimination of the sums ``m<i><j>`` and ``c<i>``: CTEs ending in ``solved`` with ``b<i>``."""
    out, last = "", source
    for p in range(k):
        cells = [f"m{i}{j} - m{i}{p} / nullif(m{p}{p}, 0) * m{p}{j} as m{i}{j}" for i in range(p + 1, k) for j in range(p + 1, k)]
        cells += [f"c{i} - m{i}{p} / nullif(m{p}{p}, 0) * c{p} as c{i}" for i in range(p + 1, k)]
        keep = [f"m{i}{j}" for i in range(p + 1) for j in range(i, k)] + [f"c{i}" for i in range(p + 1)]
        out += f"""{last}_{p} as (select {KEY}, {", ".join(f"s{i}" for i in range(k))}, {", ".join(keep + cells)} from {last}), """
        last = f"{last}_{p}"
    ok = " and ".join(f"m{p}{p} > 1e-10 * s{p}" for p in range(k))
    back = [f"(c{i}{''.join(f' - m{i}{j} * b{j}' for j in range(i + 1, k))}) / nullif(m{i}{i}, 0) as b{i}" for i in reversed(range(k))]
    return out + f"solved as (select {KEY}, {ok} as ok, {', '.join(back)} from {last})"


DRIFT = [f"drift_{p}" for p in range(4)]


@query("j2_drift", f"""with {WINS}, {STANDARD},
  d as (select *, lead(z) over (partition by {KEY} order by t) - z as step from z),
  e as (select {KEY}, bin, avg(z) as u, avg(step) as step from (select *, ntile(10) over (partition by {KEY} order by y, t) as bin from d where step is not null) group by all),
  q as (select {KEY}, {", ".join(f"sum(pow(u, {i + j})) as m{i}{j}" for i in range(4) for j in range(4))}, {", ".join(f"sum(pow(u, {i}) * step) as c{i}" for i in range(4))},
    {", ".join(f"sum(pow(u, {2 * i})) as s{i}" for i in range(4))} from e group by {KEY}),
  {_eliminate_sql('q', 4)}, x as (select {KEY}, {", ".join(f"case when ok then b{p} end as drift_{p}" for p in range(4))} from solved)
  select w.*, {_digits(DRIFT)} from (select distinct {KEY} from wins) w left join x using ({KEY})""")
def j2_drift(spark, sf):
    """Langevin drift polynomial of each window."""
    return _six(WF.drift(stored(windows(spark, sf), "windows")), *DRIFT)
