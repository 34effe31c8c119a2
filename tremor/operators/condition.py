"""Conditioning of one block of one component: gap filling, detrending, bandpass, decimation. NaN is a missing sample."""

from __future__ import annotations

import functools

import numpy as np

ORDER = 4


def fill_gaps(x: np.ndarray) -> np.ndarray:
    """Cubic Hermite over each inner gap, with tangents from the samples beyond its ends. A gap at an end, or one whose tangent needs a missing sample, stays.

    Tangents see raw samples only, so all gaps are filled at once and in any order.
    """
    x = np.asarray(x, float)
    missing = np.isnan(x)
    known = np.flatnonzero(~missing)
    gap = np.flatnonzero(np.diff(known) > 1)
    if not len(gap):
        return x.copy()
    left, right = known[gap], known[gap + 1]
    span = (right - left).astype(float)
    y0, y1, padded = x[left], x[right], np.pad(x, 1)
    m0 = np.where(left > 0, (y1 - padded[left]) / (span + 1) * span, y1 - y0)
    m1 = np.where(right + 1 < len(x), (padded[right + 2] - y0) / (span + 1) * span, y1 - y0)
    which = np.repeat(np.arange(len(gap)), right - left - 1)
    at = np.flatnonzero(missing & (np.arange(len(x)) > known[0]) & (np.arange(len(x)) < known[-1]))
    t = (at - left[which]) / span[which]
    out = x.copy()
    out[at] = (2 * t**3 - 3 * t**2 + 1) * y0[which] + (t**3 - 2 * t**2 + t) * m0[which] + (3 * t**2 - 2 * t**3) * y1[which] + (t**3 - t**2) * m1[which]
    return out


def detrend(x: np.ndarray) -> np.ndarray:
    """Takes the least squares line off the samples that are there, or their mean where they have no spread; so a lone sample among missing ones becomes 0. A series of one place stays."""
    x = np.asarray(x, float)
    ok = ~np.isnan(x)
    if len(x) < 2 or not ok.any():
        return x.copy()
    i = np.flatnonzero(ok).astype(float)
    di, dx = i - i.mean(), x[ok] - x[ok].mean()
    spread = (di * di).sum()
    out = x.copy()
    out[ok] = dx - (di * dx).sum() / spread * di if spread > 1e-12 else dx
    return out


@functools.lru_cache(64)
def _gain(n: int, fs: float, lo: float, hi: float) -> np.ndarray:
    """Squared magnitude of a Butterworth bandpass by the bilinear transform, at the frequencies of an n-point transform."""
    w1, w2 = (2 * fs * np.tan(np.pi * f / fs) for f in (lo, hi))
    f = np.fft.rfftfreq(n, 1 / fs)
    with np.errstate(all="ignore"):
        w = 2 * fs * np.tan(np.pi * f / fs)
        s = (w * w - w1 * w2) / (w * (w2 - w1))
        g = 1 / (1 + s ** (2 * ORDER))
    g[~np.isfinite(g)] = 0
    return g


def bandpass(x: np.ndarray, fs: float, lo: float, hi: float) -> np.ndarray:
    """Zero-phase bandpass of order 4: its forward and backward run multiply each frequency by the squared magnitude. Ends are continued by odd reflection, missing samples count as zero."""
    x = np.asarray(x, float)
    missing = np.isnan(x)
    if missing.all():
        return x.copy()
    y = np.where(missing, 0.0, x)
    pad = min(len(y) - 1, int(3 * fs / lo) + 1)
    long = np.concatenate([2 * y[0] - y[pad:0:-1], y, 2 * y[-1] - y[-2 : -pad - 2 : -1]])
    n = 1 << (len(long) + 2 * int(3 * fs / lo)).bit_length()
    out = np.fft.irfft(np.fft.rfft(long, n) * _gain(n, fs, lo, hi), n)[pad : pad + len(y)]
    out[missing] = np.nan
    return out


def process(x: np.ndarray, fs: float, lo: float, hi: float, factor: int, skip: int) -> np.ndarray:
    """Fill, detrend, filter, then every ``factor``-th sample from ``skip`` on."""
    x = np.asarray(x, float)
    if not np.isnan(x).all():
        x = bandpass(detrend(fill_gaps(x)), fs, lo, hi)
    return x[skip::factor]
