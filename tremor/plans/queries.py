"""Driver queries over signals derived from the test tables, and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremor.functions import dialect
from tremor.functions import features as definitions
from tremor.functions.features import DEFINITIONS, grid, records
from tremor.functions.kernels import FEATURES, hjorth, moments
from tremor.operators.scan import numbered
from tremor.plans import production
from tremor.shared import written


def _query(text: dialect.Text) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: dialect.run(spark, sf_dir, text)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: _query(f) for f in DEFINITIONS}
SQL: dict[str, str] = {f.__name__: f(dialect.DUCK) for f in DEFINITIONS}


def _table(spark: SparkSession, sf_dir: str, names: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    from tremor.functions.features import NLTA, NSTA, STEP, WIN
    from tremor.operators.signals import wave_pieces
    from tremor.plans.pipeline import window_features

    return window_features(wave_pieces(spark, sf_dir), WIN, STEP, NSTA, NLTA, names=names)


def _of_components(columns: dict[str, str], digits: int = 6) -> Callable[[SparkSession, str], DataFrame]:
    """A query for features of one component, which the production kernels compute: a row for each window and component that is whole there, ``columns`` by the features' names."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        own = [F.struct(F.lit(c).alias("component"), F.col(f"{c}_PEAK").alias("whole"), *[(F.round(f"{c}_{f}", digits) + 0.0).alias(n) for n, f in columns.items()]) for c in "ENZ"]
        rows = _table(spark, sf_dir, [f"{c}_{f}" for c in "ENZ" for f in dict.fromkeys(["PEAK", *columns.values()])]).select("station", "w", F.explode(F.array(*own)).alias("r")).where("r.whole is not null")
        return rows.select("station", "r.component", "w", *[f"r.{n}" for n in columns])

    return query


def _cross_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, [f"{p}_CROSS_CORR" for p in ("EN", "EZ", "NZ")]).select("station", "w", *[(F.round(f"{p.upper()}_CROSS_CORR", 6) + 0.0).alias(f"{p}_cross_corr") for p in ("en", "ez", "nz")])


def _power_spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tremor.functions.features import FS, STEP, WIN
    from tremor.operators.signals import wave_pieces
    from tremor.plans.pipeline import window_spectra

    own = [F.struct(F.lit(c).alias("component"), F.col(c).alias("p")) for c in "ENZ"]
    rows = window_spectra(wave_pieces(spark, sf_dir), WIN, STEP).select("station", "w", F.explode(F.array(*own)).alias("r"))
    rows = rows.where(~F.isnan(F.col("r.p")[0])).select("station", "r.component", "w", F.posexplode("r.p").alias("q", "p"))
    return rows.select("station", "component", "w", F.col("q").cast("bigint").alias("q"), (F.col("q") * FS / WIN).alias("f"), (F.round("p", 5) + 0.0).alias("p"))


def _by_kernel(kernel: Callable[[np.ndarray], tuple[np.ndarray, ...]], columns: dict[str, int]) -> Callable[[SparkSession, str], DataFrame]:
    """A query for what ``kernel`` finds in a matrix of windows of one component: ``columns``, with their digits, of each window and component that is whole there. Samples are sent as arrays, not once a window."""

    def values(e: np.ndarray, n: np.ndarray, z: np.ndarray, fs: float) -> dict[str, np.ndarray]:
        out = {}
        for c, x in zip("ENZ", (e, n, z), strict=True):
            gap = np.isnan(x).any(axis=1)
            out |= {f"{c}_{k}": np.where(gap, np.nan, v) for k, v in zip(columns, kernel(x), strict=True)}
        return out

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        from tremor.functions.features import STEP, WIN
        from tremor.operators.signals import wave_pieces
        from tremor.plans.pipeline import windows

        found = windows(wave_pieces(spark, sf_dir), WIN, STEP, values, ", ".join(f"{c}_{k} double" for c in "ENZ" for k in columns))
        own = [F.struct(F.lit(c).alias("component"), *[(F.round(f"{c}_{k}", digits) + 0.0).alias(k) for k, digits in columns.items()]) for c in "ENZ"]
        rows = found.select("station", "w", F.explode(F.array(*own)).alias("r")).where(F.col(f"r.{next(iter(columns))}").isNotNull())
        return rows.select("station", "r.component", "w", *[f"r.{k}" for k in columns])

    return query


def _moments(x: np.ndarray) -> tuple[np.ndarray, ...]:
    mean, *central = moments(x)
    return mean + 25.5, *central  # the wave is centred, the definition takes it as it is


_whole = _by_kernel(lambda x: (np.full(len(x), float(x.shape[1])),), {"n": 0})


def _hop_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whole(spark, sf_dir).select("station", "component", "w", (F.col("w") * definitions.STEP).alias("first_i"), F.col("n").cast("bigint").alias("n"))


def _window_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a station are numbered by component and stretch of windows first, so no task sorts a station."""
    rows = written(_whole(spark, sf_dir).select("station", "component", "w", F.struct("component", F.floor(F.col("w") / 4096).alias("lot")).alias("lot")), "windows")
    end = F.round((F.lit(1000.0) + (F.col("w") * definitions.STEP + definitions.WIN) / F.lit(definitions.FS)) / 60, 6) + 0.0
    label = F.concat(F.lit("s"), F.col("station").cast("string"), F.lit("_w"), F.format_string("%02d", F.col("g") + 1))
    return numbered(rows, ["station"], "lot", ["w"], "g").select("station", "component", "w", label.alias("pencere_id"), end.alias("zaman_dk"))


#: These run the production kernels; their SQL is the definition in ``tremor.functions.features``, which DuckDB alone runs.
QUERIES |= {
    "skew_kurt": _of_components({"skewness": "SKEWNESS", "kurtosis": "KURTOSIS"}),
    "peak_rms": _of_components({"peak": "PEAK", "rms": "RMS"}),
    "zero_crossing": _of_components({"zcr": "ZCR"}),
    "sta_lta": _of_components({"sta_lta_max": "STA_LTA_Max", "sta_lta_mean": "STA_LTA_Mean", "sta_lta_median": "STA_LTA_Median"}),
    "permutation_entropy": _of_components({"permutation_entropy": "PERMUTATION_ENTROPY"}),
    "dominant_freq": _of_components({"dominant_freq": "DOMINANT_FREQ"}, 9),
    "spectral_energy": _of_components({"spectral_centroid": "SPECTRAL_CENTROID", "low_freq_energy": "LOW_FREQ_ENERGY", "high_freq_energy": "HIGH_FREQ_ENERGY"}),
    "hop_windows": _hop_windows,
    "window_labels": _window_labels,
    "moments": _by_kernel(_moments, {"mean": 6, "m2": 6, "m3": 4, "m4": 3}),
    "hjorth": _by_kernel(hjorth, {"activity": 6, "mobility": 6, "complexity": 6}),
    "hjorth_standard": _by_kernel(lambda x: hjorth(x, True), {"activity": 6, "mobility": 6, "complexity": 6}),
    "cross_corr": _cross_corr,
    "power_spectrum": _power_spectrum,
}

#: Added before rounding: many variances are exact binary fractions that lie half way between two decimals.
OFF_TIES = 1.234567e-7


def rounded(column: str) -> Column:
    return (F.round(F.nanvl(F.col(column), F.lit(None).cast("double")) + OFF_TIES, 5) + 0.0).alias(column)


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features of all windows from matrices of windows: the fast way to what the other queries define one by one."""
    return _table(spark, sf_dir).select("station", "w", *map(rounded, FEATURES))


def feature_dev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First differences of the rounded features between windows of a station."""
    order = Window.partitionBy("station").orderBy("run", "w")
    rows = _table(spark, sf_dir).select("station", "run", "w", *map(rounded, FEATURES))
    return rows.select("station", "w", *[(F.round(F.col(f) - F.lag(f).over(order), 5) + 0.0).alias(f"{f}_DEV") for f in FEATURES])


def bandpass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid of each component, filled, without trend and filtered between a cycle in two days and one in five hours."""
    from tremor.operators.condition import process

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")
        return pd.DataFrame({"component": pdf.component, "i": pdf.i, "x": process(pdf.x.to_numpy(float), 1.0, 1 / 48, 1 / 5, 1, 0)})

    rows = dialect.run(spark, sf_dir, lambda d: f"with {grid(d)} select component, i, x from full_grid")
    made = rows.groupBy("component").applyInPandas(run, "component string, i bigint, x double")
    return made.select("component", "i", (F.round(F.nanvl("x", F.lit(None).cast("double")), 6) + 0.0).alias("x"))


def overlap_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of several records' samples on one place of the grid the one of the last record stands. Start, file and offset make one decimal, so the samples of a task are hashed by place and not sorted."""
    text = lambda d: f"with {records(d)} select component, cast(round((start_epoch - 1704067200e0) * fs) as bigint) as first, n, value, start_epoch, file_idx, rec_offset from records"
    start, file, offset = F.coalesce(F.round(F.col("start_epoch") * 1e6).cast("bigint"), F.lit(-(10**16))), F.coalesce("file_idx", F.lit(-8)) + 8, F.coalesce("rec_offset", F.lit(-(2**63)))
    place = (start * 16 + file).cast("decimal(18,0)") * F.lit(Decimal(2 * 10**19)).cast("decimal(20,0)")
    rows = dialect.run(spark, sf_dir, text).withColumn("last", (place + offset.cast("decimal(19,0)")).cast("decimal(38,0)"))
    samples = rows.select("component", "first", "value", "last", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("j"))
    samples = samples.select("component", (F.col("first") + F.col("j")).alias("i"), (F.col("value") + F.col("j")).alias("x"), "last")
    return samples.groupBy("component", "i").agg((F.round(F.max_by("x", "last"), 6) + 0.0).alias("x"), F.count("*").alias("written"))


def block_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records planned into blocks, assembled, conditioned and decimated: samples and mean square of each block."""
    from tremor.config import Config
    from tremor.plans.pipeline import blocks_of, plan_blocks

    text = lambda d: f"with {records(d)} select cast(station as string) as station, cast(file_idx as string) as path, rec_offset as `offset`, start_epoch, component, cast(n as int) as `count`, fs, transform(sequence(0L, n - 1), j -> value + sin(j)) as samples from records"
    rows = dialect.run(spark, sf_dir, text)
    native = 1 / 60
    cfg = Config(fs=native / 2, freqmin=native / 200, freqmax=native / 8)
    plan = plan_blocks(rows.drop("samples"), 2, block_s=86400, slack_s=6000, context_s=7200, reset_s=172800)
    chunks = blocks_of(rows, plan, cfg, native)
    power = lambda c: F.round(F.aggregate(F.filter(c, lambda v: v.isNotNull() & ~F.isnan(v)), F.lit(0.0), lambda a, v: a + v * v), 6).alias(f"{c}_power")
    return chunks.select("station", "segment", "block", F.round("start_epoch", 3).alias("start_epoch"), F.size("e").alias("n"), *map(power, "enz"))


QUERIES |= {f.__name__: f for f in (feature_table, feature_dev, bandpass, overlap_last_wins, block_pipeline)}


def _exact(text: str) -> str:
    """A definition's SQL without the rounding of its results, which is to be done once."""
    at = 0
    while (at := text.find("round(", at)) >= 0:
        depth, end = 1, at + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(text[end], 0)
            end += 1
        inner = text[at + 6 : end - 1]
        if text[end:].startswith(" + 0.0e0 as"):
            text = text[:at] + "(" + inner.rpartition(",")[0] + ")" + text[end + 8 :]
        at += 1
    return text


def _feature_table_sql() -> str:
    """The definitions one by one, joined and turned by component; windows where any component is whole."""
    d = dialect.DUCK
    parts = {"sk": definitions.skew_kurt, "pr": definitions.peak_rms, "zc": definitions.zero_crossing, "sl": definitions.sta_lta, "hj": definitions.hjorth, "pe": definitions.permutation_entropy, "df": definitions.dominant_freq, "se": definitions.spectral_energy}
    own = {
        "DOMINANT_FREQ": "df.dominant_freq", "HIGH_FREQ_ENERGY": "se.high_freq_energy", "HJORTH_ACTIVITY": "hj.activity", "HJORTH_COMPLEXITY": "hj.complexity", "HJORTH_MOBILITY": "hj.mobility", "KURTOSIS": "sk.kurtosis",
        "LOW_FREQ_ENERGY": "se.low_freq_energy", "PEAK": "pr.peak", "PERMUTATION_ENTROPY": "pe.permutation_entropy", "RMS": "pr.rms", "SKEWNESS": "sk.skewness", "SPECTRAL_CENTROID": "se.spectral_centroid", "STA_LTA_Max": "sl.sta_lta_max",
        "STA_LTA_Mean": "sl.sta_lta_mean", "STA_LTA_Median": "sl.sta_lta_median", "ZCR": "zc.zcr",
    }
    using = "using (station, component, w)"
    joined = " ".join(f"left join {p} {using}" for p in parts if p != "pr")
    singles = ", ".join(f"max(case when component = '{c}' then round({v} + {OFF_TIES}, 5) end) + 0.0e0 as {c}_{n}" for c in "ENZ" for n, v in own.items())
    return f"""with {", ".join(f"{p} as ({_exact(f(d))})" for p, f in parts.items())}, cc as ({_exact(definitions.cross_corr(d))}),
t as (select station, w, {singles} from pr {joined} group by station, w)
select t.*, round(en_cross_corr + {OFF_TIES}, 5) + 0.0e0 as EN_CROSS_CORR, round(ez_cross_corr + {OFF_TIES}, 5) + 0.0e0 as EZ_CROSS_CORR, round(nz_cross_corr + {OFF_TIES}, 5) + 0.0e0 as NZ_CROSS_CORR from t left join cc using (station, w)"""


SQL["feature_table"] = _feature_table_sql()
SQL["feature_dev"] = f"with f as ({_feature_table_sql()}) select station, w, " + ", ".join(f'round("{f}" - lag("{f}") over (partition by station order by w), 5) + 0.0e0 as "{f}_DEV"' for f in FEATURES) + " from f"
QUERIES |= production.QUERIES
SQL |= production.SQL | {"bandpass": production.BANDPASS_SQL}
FLAGSHIP = "feature_dev"
