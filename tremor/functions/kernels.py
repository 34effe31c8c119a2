"""Features of many windows at once, as numpy arrays of one row a window."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

SPLIT = 1.0
COMPONENTS = ("E", "N", "Z")
#: In the order of the feature table's columns.
SINGLE = [
    "DOMINANT_FREQ", "HIGH_FREQ_ENERGY", "HJORTH_ACTIVITY", "HJORTH_COMPLEXITY", "HJORTH_MOBILITY", "KURTOSIS", "LOW_FREQ_ENERGY", "PEAK", "PERMUTATION_ENTROPY", "RMS", "SKEWNESS", "SPECTRAL_CENTROID", "STA_LTA_Max",
    "STA_LTA_Mean", "STA_LTA_Median", "ZCR",
]
FEATURES = ["EN_CROSS_CORR", "EZ_CROSS_CORR", *(f"E_{n}" for n in SINGLE), "NZ_CROSS_CORR", *(f"N_{n}" for n in SINGLE), *(f"Z_{n}" for n in SINGLE)]


def _ratio(a: np.ndarray, b: np.ndarray, none: float = np.nan) -> np.ndarray:
    with np.errstate(all="ignore"):
        return np.where(b > 0, a / np.where(b > 0, b, 1), none)


def zscore(x: np.ndarray) -> np.ndarray:
    """Rows to mean 0 and deviation 1; a row without variance stays."""
    std = x.std(axis=1, keepdims=True)
    return np.where(std > 0, (x - x.mean(axis=1, keepdims=True)) / np.where(std > 0, std, 1), x)


def power(z: np.ndarray) -> np.ndarray:
    return np.abs(np.fft.rfft(z, axis=1)) ** 2 / z.shape[1]


def sta_lta(z: np.ndarray, nsta: int, nlta: int) -> np.ndarray:
    """Ratios of trailing mean squares, one column for each place from the first full long average on."""
    s = np.pad(np.cumsum(z * z, axis=1), ((0, 0), (1, 0)))
    at = np.arange(nlta, z.shape[1] + 1)
    short, long = (s[:, at] - s[:, at - nsta]) / nsta, (s[:, at] - s[:, at - nlta]) / nlta
    return np.where(long > 1e-12, short / np.where(long > 1e-12, long, 1), 0.0)


def hjorth(x: np.ndarray, standard: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Activity, mobility, complexity. Unless ``standard``, the difference at place 2 is taken from place 0."""
    d = np.diff(x, axis=1)
    if not standard:
        d[:, 1] = x[:, 2] - x[:, 0]
    dd = np.diff(d, axis=1)
    if not standard:
        dd[:, 0] = x[:, 2] - x[:, 1]
    v0, v1, v2 = x.var(axis=1), d.var(axis=1), dd.var(axis=1)
    mobility = np.sqrt(_ratio(v1, v0, 0))
    return v0, mobility, _ratio(np.sqrt(_ratio(v2, v1, 0)), mobility, 0)


def permutation_entropy(x: np.ndarray) -> np.ndarray:
    a, b, c = x[:, :-2], x[:, 1:-1], x[:, 2:]
    order = np.where(a <= b, np.where(b <= c, 0, np.where(a <= c, 1, 2)), np.where(a <= c, 3, np.where(b <= c, 4, 5)))
    p = np.stack([(order == k).mean(axis=1) for k in range(6)])
    return -np.sum(np.where(p > 0, p * np.log(np.where(p > 0, p, 1)), 0), axis=0) / np.log(6)


def correlation(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Pearson's of each pair of rows; NaN without variance or where a sample is missing."""
    x, y = x - x.mean(axis=1, keepdims=True), y - y.mean(axis=1, keepdims=True)
    return _ratio((x * y).sum(axis=1), np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1)))


def moments(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Mean and the central moments 2 to 4 of each row."""
    mean = x.mean(axis=1)
    c = x - mean[:, None]
    return mean, (c * c).mean(axis=1), (c * c * c).mean(axis=1), (c * c * c * c).mean(axis=1)


def single(x: np.ndarray, fs: float, nsta: int, nlta: int, standard_hjorth: bool = False, names: Iterable[str] = SINGLE) -> dict[str, np.ndarray]:
    """The features ``names`` of windows of one component; NaN for windows with a missing sample. What none of them needs is not computed."""
    out = {n: np.full(len(x), np.nan) for n in names}
    ok = ~np.isnan(x).any(axis=1)
    if not ok.any():
        return out
    x = x[ok]
    n = x.shape[1]
    wanted = lambda *some: any(s in out for s in some)

    def put(name, v):
        if name in out:
            out[name][ok] = v

    if wanted("SKEWNESS", "KURTOSIS"):
        _, m2, m3, m4 = moments(x)
        put("SKEWNESS", _ratio(m3, m2**1.5))
        put("KURTOSIS", _ratio(m4, m2**2))
    put("PEAK", np.abs(x).max(axis=1))
    if wanted("RMS"):
        put("RMS", np.sqrt((x * x).mean(axis=1)))
    if n > 1 and wanted("ZCR"):
        put("ZCR", ((x[:, 1:] >= 0) != (x[:, :-1] >= 0)).mean(axis=1))
    if n > 2 and wanted("HJORTH_ACTIVITY", "HJORTH_MOBILITY", "HJORTH_COMPLEXITY"):
        for name, v in zip(("HJORTH_ACTIVITY", "HJORTH_MOBILITY", "HJORTH_COMPLEXITY"), hjorth(x, standard_hjorth), strict=True):
            put(name, v)
    if n > 2 and wanted("PERMUTATION_ENTROPY"):
        put("PERMUTATION_ENTROPY", permutation_entropy(x))
    spectral = wanted("SPECTRAL_CENTROID", "LOW_FREQ_ENERGY", "HIGH_FREQ_ENERGY", "DOMINANT_FREQ")
    averages = wanted("STA_LTA_Max", "STA_LTA_Mean", "STA_LTA_Median")
    if not spectral and not averages:
        return out
    z = zscore(x)
    if averages and n > nlta >= nsta > 0:
        r = sta_lta(z, nsta, nlta)
        flat = ~z.any(axis=1)  # an all-zero window has no defined ratio
        for name, v in (("Max", r.max(axis=1)), ("Mean", r.mean(axis=1)), ("Median", np.median(r, axis=1))):
            put(f"STA_LTA_{name}", np.where(flat, np.nan, v))
    if not spectral:
        return out
    p, f = power(z), np.arange(n // 2 + 1) * fs / n
    total = p.sum(axis=1)
    put("SPECTRAL_CENTROID", _ratio(p @ f, total, 0))
    put("LOW_FREQ_ENERGY", _ratio(p[:, f <= SPLIT].sum(axis=1), total, 0))
    put("HIGH_FREQ_ENERGY", _ratio(p[:, f > SPLIT].sum(axis=1), total, 0))
    back = np.round(p[:, :0:-1], 7)  # of equals the highest frequency
    put("DOMINANT_FREQ", f[n // 2 - back.argmax(axis=1)] if n > 1 else np.nan)
    return out


def features(e: np.ndarray, n: np.ndarray, z: np.ndarray, fs: float, nsta: int, nlta: int, standard_hjorth: bool = False, names: Iterable[str] = FEATURES) -> dict[str, np.ndarray]:
    """The features ``names``, of 51, of windows of three components."""
    out = {}
    for name, x in zip(COMPONENTS, (e, n, z), strict=True):
        own = [k for k in SINGLE if f"{name}_{k}" in names]
        out |= {f"{name}_{k}": v for k, v in single(x, fs, nsta, nlta, standard_hjorth, own).items()} if own else {}
    out |= {f"{p}_CROSS_CORR": correlation(x, y) for p, x, y in (("EN", e, n), ("EZ", e, z), ("NZ", n, z)) if f"{p}_CROSS_CORR" in names}
    return {k: out[k] for k in names}
