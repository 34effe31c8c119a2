"""SQL definitions of the signal features, each over hopping count windows of a gap-free signal, and of the assembly and conditioning steps.

Every definition is a function of the engine's dialect. The signals are those of ``tremor.operators.signals``.
"""

from __future__ import annotations

from tremor.functions.dialect import Spark

#: Window and step in samples, nominal rate, lengths of the short and the long average, and the frequency that splits the energies.
WIN, STEP, FS, NSTA, NLTA, SPLIT = 64, 16, 5.0, 2, 30, 1.0


def wave(d: Spark, x: str = "l_quantity") -> str:
    return f"""wave as (select l_suppkey as station, case l_returnflag when 'A' then 'E' when 'N' then 'N' when 'R' then 'Z' end as component,
  cast(row_number() over (partition by l_suppkey, l_returnflag order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 as bigint) as i,
  {x} as x from {d.table("lineitem")})"""


def hop(d: Spark, x: str = "l_quantity", win: int = WIN, step: int = STEP) -> str:
    """station, component, w, k (place in the window), x and the window's mean; full windows only. A sample is dealt to the windows that hold it."""
    return f"""{wave(d, x)},
dealt as (select station, component, i, x, {d.each(f"greatest(cast(0 as bigint), cast(ceil((i - {win} + 1) / {float(step)}e0) as bigint))", f"cast(floor(i / {float(step)}e0) as bigint)")} as w from wave),
hop as (select station, component, w, i - w * {step} as k, x, mu from (
  select *, count(x) over (partition by station, component, w) as c, avg(x) over (partition by station, component, w) as mu from dealt) q where c = {win})"""


def moments(d: Spark) -> str:
    return f"""with {hop(d)} select station, component, w, round(avg(x), 6) + 0.0e0 as mean, round(var_pop(x), 6) + 0.0e0 as m2,
  round(avg((x - mu) * (x - mu) * (x - mu)), 4) + 0.0e0 as m3, round(avg((x - mu) * (x - mu) * (x - mu) * (x - mu)), 3) + 0.0e0 as m4 from hop group by station, component, w"""


def skew_kurt(d: Spark) -> str:
    """Population skewness and kurtosis that is not excess; null without variance."""
    own = "skewness(x)" if d.spark else "avg((x - mu) * (x - mu) * (x - mu)) / nullif(pow(var_pop(x), 1.5), 0)"
    kurt = "kurtosis(x) + 3" if d.spark else "avg((x - mu) * (x - mu) * (x - mu) * (x - mu)) / nullif(var_pop(x) * var_pop(x), 0)"
    return f"with {hop(d)} select station, component, w, round({own}, 6) + 0.0e0 as skewness, round({kurt}, 6) + 0.0e0 as kurtosis from hop group by station, component, w"


def peak_rms(d: Spark) -> str:
    return f"with {hop(d, 'l_quantity - 25.5e0')} select station, component, w, max(abs(x)) as peak, round(sqrt(avg(x * x)), 6) + 0.0e0 as rms from hop group by station, component, w"


def zero_crossing(d: Spark) -> str:
    """Share of neighbours that lie on two sides of zero; zero itself counts as above."""
    return f"""with {hop(d, "l_quantity - 25.5e0")}, pairs as (select *, lag(x) over (partition by station, component, w order by k) as p from hop)
select station, component, w, round(cast(count_if((p >= 0) <> (x >= 0)) as double) / {WIN - 1}, 6) + 0.0e0 as zcr from pairs group by station, component, w"""


def sta_lta(d: Spark) -> str:
    """Ratio of trailing mean squares of z-scores, from running sums rather than frames of the long length; 0 where the long one vanishes."""
    return f"""with {hop(d)}, z as (select station, component, w, k, {d.div("x - mu", "stddev_pop(x) over (partition by station, component, w)")} as z from hop),
run as (select *, sum(z * z) over (partition by station, component, w order by k rows unbounded preceding) as s from z),
cut as (select station, component, w, k, s, coalesce(lag(s, {NSTA}) over (partition by station, component, w order by k), 0) as a,
  coalesce(lag(s, {NLTA}) over (partition by station, component, w order by k), 0) as b from run),
ratio as (select station, component, w, case when (s - b) / {NLTA} <= 1e-12 then 0e0 else ((s - a) / {NSTA}) / ((s - b) / {NLTA}) end as r from cut where k >= {NLTA - 1} and s is not null)
select station, component, w, round(max(r), 6) + 0.0e0 as sta_lta_max, round(avg(r), 6) + 0.0e0 as sta_lta_mean, round(median(r), 6) + 0.0e0 as sta_lta_median from ratio group by station, component, w"""


def _hjorth(d: Spark, quirk: bool) -> str:
    # With the quirk the first step inside the loop is taken from the first sample, so the second difference is x2 - x0.
    dx = "case when k = 2 then x - lag(x, 2) over v else x - lag(x) over v end" if quirk else "x - lag(x) over v"
    ddx = "case when k = 2 then x - lag(x) over v when k = 3 then (x - lag(x) over v) - (lag(x) over v - lag(x, 3) over v) else (x - lag(x) over v) - (lag(x) over v - lag(x, 2) over v) end" if quirk else "case when k >= 2 then (x - lag(x) over v) - (lag(x) over v - lag(x, 2) over v) end"
    return f"""with {hop(d)}, diffs as (select station, component, w, x, case when k >= 1 then {dx} end as dx, case when k >= 2 then {ddx} end as ddx from hop window v as (partition by station, component, w order by k)),
v as (select station, component, w, var_pop(x) as v0, var_pop(dx) as v1, var_pop(ddx) as v2 from diffs group by station, component, w)
select station, component, w, round(v0, 6) + 0.0e0 as activity, round(coalesce(sqrt({d.div("v1", "v0")}), 0), 6) + 0.0e0 as mobility,
  round(coalesce({d.div(f"sqrt({d.div('v2', 'v1')})", f"sqrt({d.div('v1', 'v0')})")}, 0), 6) + 0.0e0 as complexity from v"""


def hjorth(d: Spark) -> str:
    return _hjorth(d, True)


def hjorth_standard(d: Spark) -> str:
    return _hjorth(d, False)


def permutation_entropy(d: Spark) -> str:
    """Entropy of the six orders of three neighbours, over that of equal shares; equal neighbours count as ascending."""
    return f"""with {hop(d)}, t as (select station, component, w, lag(x, 2) over v as a, lag(x) over v as b, x as c from hop window v as (partition by station, component, w order by k)),
o as (select station, component, w, case when a <= b and b <= c then 0 when a <= b and a <= c then 1 when a <= b then 2 when a <= c then 3 when b <= c then 4 else 5 end as o from t where a is not null),
p as (select station, component, w, o, cast(count(*) as double) / {WIN - 2} as p from o group by station, component, w, o)
select station, component, w, round(-sum(p * ln(p)) / ln(6e0), 6) + 0.0e0 as permutation_entropy from p group by station, component, w"""


def cross_corr(d: Spark) -> str:
    """Correlation of two components' windows of one number; null if either is not whole or has no variance."""
    pair = lambda a, b: d.div(f"covar_pop({a}, {b})", f"stddev_pop({a}) * stddev_pop({b})")
    return f"""with {hop(d)}, m as (select station, w, k, max(case when component = 'E' then x end) as e, max(case when component = 'N' then x end) as n, max(case when component = 'Z' then x end) as z from hop group by station, w, k)
select station, w, round({pair("e", "n")}, 6) + 0.0e0 as en_cross_corr, round({pair("e", "z")}, 6) + 0.0e0 as ez_cross_corr, round({pair("n", "z")}, 6) + 0.0e0 as nz_cross_corr from m group by station, w"""


def spectrum(d: Spark) -> str:
    """Power of the z-scored window at each frequency, by the definition of the transform."""
    turn = f"2e0 * pi() * cast((q * k) % {WIN} as double) / {WIN}"
    return f"""{hop(d)}, z as (select station, component, w, k, coalesce({d.div("x - mu", "stddev_pop(x) over (partition by station, component, w)")}, x) as z from hop),
fan as (select station, component, w, k, z, {d.each("cast(0 as bigint)", f"cast({WIN // 2} as bigint)")} as q from z),
power as (select station, component, w, q, cast(q as double) * {FS} / {WIN} as f, (pow(sum(z * cos({turn})), 2) + pow(sum(z * sin({turn})), 2)) / {WIN} as p from fan group by station, component, w, q)"""


def power_spectrum(d: Spark) -> str:
    return f"with {spectrum(d)} select station, component, w, q, f, round(p, 5) + 0.0e0 as p from power"


def dominant_freq(d: Spark) -> str:
    """Frequency of most power, zero left out; of equals the highest."""
    return f"with {spectrum(d)} select station, component, w, {d.arg_max('f', 'round(p, 7)', 'q')} as dominant_freq from power where q > 0 group by station, component, w"


def spectral_energy(d: Spark) -> str:
    share = lambda v: f"round(coalesce({d.div(f'sum({v})', 'sum(p)')}, 0), 6) + 0.0e0"
    return f"""with {spectrum(d)} select station, component, w, {share("f * p")} as spectral_centroid, {share(f"case when f <= {SPLIT} then p else 0 end")} as low_freq_energy,
  {share(f"case when f > {SPLIT} then p else 0 end")} as high_freq_energy from power group by station, component, w"""


def hop_windows(d: Spark) -> str:
    return f"with {hop(d)} select station, component, w, min(w * {STEP}) as first_i, cast(count(*) as bigint) as n from hop group by station, component, w"


def window_labels(d: Spark) -> str:
    """Label with a number of at least two digits that runs across a station's series, and the time of the window's end in minutes."""
    return f"""with {hop(d)}, w as (select station, component, w from hop group by station, component, w), n as (select *, row_number() over (partition by station order by component, w) as g from w)
select station, component, w, concat('s', cast(station as varchar(20)), '_w', {d.pad2("cast(g as bigint)")}) as pencere_id, round((1000e0 + (w * {STEP} + {WIN}) / {FS}) / 60, 6) + 0.0e0 as zaman_dk from n"""


def grid(d: Spark, cell: int = 3600) -> str:
    """component, i, x of the filled cells of a regular grid, and ``full`` with all cells of the span."""
    return f"""cells as (select case event_type when 'click' then 'E' when 'view' then 'N' when 'purchase' then 'Z' end as component,
  cast(floor(({d.epoch("ts")} - 1704067200e0) / {cell}) as bigint) as i, avg(value) as x from {d.table("events")} where event_type in ('click', 'view', 'purchase') group by 1, 2),
span as (select component, {d.each("lo", "hi")} as i from (select min(i) as lo, max(i) as hi from cells) s, (select distinct component from cells) c),
full_grid as (select span.component, span.i, cells.x from span left join cells on cells.component = span.component and cells.i = span.i)"""


def grid_assembly(d: Spark) -> str:
    return f"with {grid(d)} select component, i, round(x, 6) + 0.0e0 as x from full_grid"


def gap_fill(d: Spark) -> str:
    """Cubic Hermite with Catmull-Rom tangents over each gap; a gap at an end, or next to an isolated sample, stays."""
    before, after = "(partition by component order by i rows between unbounded preceding and current row)", "(partition by component order by i rows between current row and unbounded following)"
    known = lambda v: f"case when x is not null then {v} end"
    return f"""with {grid(d)}, near as (select *, lag(x) over (partition by component order by i) as px, lead(x) over (partition by component order by i) as nx,
  lag(i) over (partition by component order by i) as pi_, lead(i) over (partition by component order by i) as ni from full_grid),
ends as (select component, i, x, {d.last(known("i"))} over {before} as l, {d.last("x")} over {before} as y0, {d.first(known("i"))} over {after} as r, {d.first("x")} over {after} as y1,
  {d.last(known("coalesce(px, 1e308)"))} over {before} as pl, {d.last(known("case when pi_ is null then 1 else 0 end"))} over {before} as l_edge,
  {d.first(known("coalesce(nx, 1e308)"))} over {after} as nr, {d.first(known("case when ni is null then 1 else 0 end"))} over {after} as r_edge from near),
t as (select *, cast(r - l as double) as span, cast(i - l as double) / nullif(cast(r - l as double), 0) as t,
  case when l_edge = 1 then y1 - y0 when pl = 1e308 then null else (y1 - pl) / (r - l + 1) * (r - l) end as m0,
  case when r_edge = 1 then y1 - y0 when nr = 1e308 then null else (nr - y0) / (r - l + 1) * (r - l) end as m1 from ends)
select component, i, round(case when x is not null then x else (2 * t * t * t - 3 * t * t + 1) * y0 + (t * t * t - 2 * t * t + t) * m0 + (3 * t * t - 2 * t * t * t) * y1 + (t * t * t - t * t) * m1 end, 4) + 0.0e0 as x, x is null as missing from t"""


def detrend(d: Spark) -> str:
    """Least squares line over the place, taken off where a sample is; of a lone sample its mean."""
    return f"""with {grid(d)}, fit as (select component, coalesce({d.div("covar_pop(x, cast(i as double))", "var_pop(case when x is not null then cast(i as double) end)")}, 0) as b, avg(x) as mx, avg(case when x is not null then cast(i as double) end) as mi, count(*) as n from full_grid group by component)
select g.component, g.i, round(case when f.n < 2 then g.x else g.x - f.mx - f.b * (g.i - f.mi) end, 5) + 0.0e0 as x from full_grid g join fit f on f.component = g.component"""


def decimate(d: Spark) -> str:
    """Every fifth sample by its absolute place."""
    return f"with {wave(d)} select station, component, i, cast(floor(i / 5e0) as bigint) as out_i, x from wave where i % 5 = 0"


def nan_counts(d: Spark) -> str:
    return f"with {grid(d)} select component, cast(count(*) as bigint) as samples, cast(count(*) - count(x) as bigint) as missing from full_grid group by component"


def nan_guard(d: Spark) -> str:
    """Features of a component's window are null if any sample of it is missing."""
    return f"""with {grid(d)}, dealt as (select component, i, x, {d.each("greatest(cast(0 as bigint), cast(ceil((i - 24 + 1) / 12e0) as bigint))", "cast(floor(i / 12e0) as bigint)")} as w from full_grid)
select component, w, cast(count(x) as bigint) as present, round(case when count(x) = 24 then avg(x) end, 6) + 0.0e0 as mean from dealt group by component, w having count(*) = 24"""


def records(d: Spark) -> str:
    """A pseudo index of records of 1 to 100 samples at one sample a minute, of four stations."""
    return f"""records as (select user_id % 4 as station, user_id % 8 as file_idx, event_id as rec_offset, {d.epoch("ts")} as start_epoch, cast(1 + event_id % 100 as bigint) as n, 1e0 / 60 as fs,
  case event_type when 'click' then 'E' when 'view' then 'N' when 'purchase' then 'Z' end as component, value from {d.table("events")} where event_type in ('click', 'view', 'purchase'))"""


def component_map(d: Spark) -> str:
    """Component of a source id: its part after the last _ or ., first letter; 1 and 2 are E and N. Others, and empty or rateless records, are dropped."""
    tail = "upper(substring(regexp_extract(sid, '([^_.]*)$', 1), 1, 1))"
    return f"""with ids as (select event_id, concat('XX.STA', cast(user_id % 7 as varchar(20)), case when event_id % 2 = 0 then '.B_H_' else '_HH.' end, case event_type when 'click' then 'Z' when 'view' then 'n' when 'purchase' then '1' when 'signup' then '2x' else 'H' end) as sid,
  event_id % 5 as n, case when event_id % 11 = 0 then 0e0 else 100e0 end as fs from {d.table("events")}),
named as (select event_id, sid, case {tail} when 'Z' then 'Z' when 'N' then 'N' when '2' then 'N' when 'E' then 'E' when '1' then 'E' end as component, n, fs from ids)
select event_id, sid, component from named where component is not null and n > 0 and fs > 0"""


def rate_check(d: Spark) -> str:
    """Files whose rate differs from the first by more than 1e-6."""
    return f"""with f as (select user_id % 16 as file_idx, event_id, 100e0 + case when user_id % 16 = 3 then 0.5e0 when user_id % 16 = 5 then 1e-9 else 0 end as fs from {d.table("events")}),
a as (select file_idx, min(fs) as lo, max(fs) as hi from f group by file_idx), b as (select min(fs) as fs from f where event_id = (select min(event_id) from f))
select a.file_idx, a.lo, a.hi, abs(a.lo - b.fs) > 1e-6 or a.hi - a.lo > 1e-6 as mixed from a, b"""


def component_completeness(d: Spark) -> str:
    return f"""with r as (select user_id as station, case event_type when 'click' then 'E' when 'view' then 'N' when 'purchase' then 'Z' end as component from {d.table("events")})
select station, cast(count(distinct component) as bigint) as components, max(case when component = 'E' then 1 else 0 end) = 1 as has_e, max(case when component = 'N' then 1 else 0 end) = 1 as has_n, max(case when component = 'Z' then 1 else 0 end) = 1 as has_z from r group by station"""


def overlap_last_wins(d: Spark) -> str:
    """Of several records' samples on one place of the grid the one of the last record stands."""
    return f"""with {records(d)}, s as (select component, cast(round((start_epoch - 1704067200e0) * fs) as bigint) + j as i, value + j as x, start_epoch, file_idx, rec_offset from (select *, {d.each("cast(0 as bigint)", "n - 1")} as j from records) q)
select component, i, round({d.arg_max("x", "start_epoch", "file_idx", "rec_offset")}, 6) + 0.0e0 as x, cast(count(*) as bigint) as written from s group by component, i"""


_ORDER = "order by start_epoch, file_idx, rec_offset"


def running_watermark(d: Spark) -> str:
    return f"with {records(d)} select station, component, rec_offset, round(max(start_epoch + (n - 1) / fs) over (partition by station, component {_ORDER} rows unbounded preceding), 3) + 0.0e0 as watermark from records"


BLOCK_S, SLACK_S = 14400, 1440


def _late(d: Spark) -> str:
    return f"""{records(d)}, m as (select *, max(start_epoch + (n - 1) / fs) over (partition by station {_ORDER} rows between unbounded preceding and 1 preceding) as wm, min(start_epoch) over (partition by station) as start0 from records),
k as (select *, greatest(0e0, floor((coalesce(wm, start0) - start0 - {SLACK_S}) / {BLOCK_S})) as blocks from m)"""


def tumbling_blocks(d: Spark) -> str:
    """Blocks that are out before each record arrives."""
    return f"with {_late(d)} select rec_offset, component, cast(blocks as bigint) as blocks from k"


def late_drop(d: Spark) -> str:
    """Records that begin before the block then open."""
    return f"with {_late(d)} select rec_offset, component, round((start_epoch - start0 - {BLOCK_S} * blocks) * fs) < 0 as late from k"


def gap_sessions(d: Spark) -> str:
    """Runs of records of a user without a pause of over two hours."""
    return f"""with r as (select user_id, event_id, {d.epoch("ts")} as t from {d.table("events")}), g as (select *, case when t - lag(t) over (partition by user_id order by t) > 7200 then 1 else 0 end as reset from r),
s as (select *, sum(reset) over (partition by user_id order by t rows unbounded preceding) as session from g)
select user_id, cast(session as bigint) as session, cast(count(*) as bigint) as n, round(min(t), 3) as first_t, round(max(t), 3) as last_t from s group by user_id, session"""


def block_context(d: Spark) -> str:
    """Samples of each block of 100 with the last 20 of the block before."""
    return f"""with {wave(d)}, b as (select station, component, i, x, cast(floor(i / 100e0) as bigint) as own, i % 100 as pos from wave),
c as (select station, component, i, x, own, pos, {d.each("own", "case when pos >= 80 then own + 1 else own end")} as block from b),
l as (select station, component, max(own) as last_block from b group by station, component)
select c.station, c.component, c.block, cast(count(*) as bigint) as n, cast(count_if(c.own < c.block) as bigint) as lead, round(sum(c.x), 3) + 0.0e0 as total from c join l on l.station = c.station and l.component = c.component where c.block <= l.last_block group by c.station, c.component, c.block"""


def _chunks(d: Spark) -> str:
    return f"""chunks as (select user_id as station, event_id, {d.epoch("ts")} as start_epoch, cast(60 + event_id % 7 as bigint) as n, 1e0 / 60 as fs from {d.table("events")}),
told as (select *, lag(start_epoch + n / fs) over (partition by station order by start_epoch) as expected from chunks),
cut as (select *, sum(n) over (partition by station order by start_epoch rows unbounded preceding) - n as sample_offset, case when expected is null or abs(start_epoch - expected) >= 0.5e0 / fs then 1 else 0 end as new_segment from told)"""


def segment_table(d: Spark) -> str:
    """First sample and time of each segment of contiguous chunks."""
    return f"with {_chunks(d)} select station, cast(sample_offset as bigint) as sample_offset, round(start_epoch, 3) as start_epoch from cut where new_segment = 1"


def sample_time_lookup(d: Spark) -> str:
    """Time of samples by the last segment that begins at or before each."""
    seg = d.last("case when kind = 0 then seg_offset end"), d.last("case when kind = 0 then seg_start end")
    over = "over (partition by station order by pos, kind rows unbounded preceding)"
    return f"""with {_chunks(d)}, seg as (select station, sample_offset, start_epoch from cut where new_segment = 1), asked as (select station, sample_offset + n - 1 as pos from cut),
both_rows as (select station, sample_offset as pos, 0 as kind, sample_offset as seg_offset, start_epoch as seg_start from seg union all select station, pos, 1, null, null from asked),
found as (select station, pos, kind, {seg[0]} {over} as o, {seg[1]} {over} as s from both_rows)
select station, cast(pos as bigint) as sample, round(s + (pos - o) * 60e0, 3) as t from found where kind = 1"""


def f32_rows(d: Spark) -> str:
    """Interleaved single precision samples up to the shortest component."""
    return f"""with {wave(d)}, m as (select station, i, max(case when component = 'E' then x end) as e, max(case when component = 'N' then x end) as n, max(case when component = 'Z' then x end) as z from wave group by station, i)
select station, i, cast(cast(e * 1.1e0 as float) as double) as e, cast(cast(n * 1.1e0 as float) as double) as n, cast(cast(z * 1.1e0 as float) as double) as z from m where e is not null and n is not null and z is not null"""


DEFINITIONS = [
    component_map, rate_check, component_completeness, grid_assembly, overlap_last_wins, running_watermark, tumbling_blocks, late_drop, gap_sessions, block_context, gap_fill, detrend, decimate, segment_table,
    f32_rows, nan_counts, nan_guard, sample_time_lookup, hop_windows, window_labels, moments, skew_kurt, peak_rms, zero_crossing, sta_lta, hjorth, hjorth_standard, permutation_entropy, cross_corr, power_spectrum,
    dominant_freq, spectral_energy,
]
