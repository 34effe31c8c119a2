"""Conditioning, planning and features against plain restatements."""

import random

import numpy as np
import pytest

from tremor.config import Config
from tremor.functions import kernels
from tremor.operators.assemble import Planner, check_index
from tremor.operators.condition import bandpass, detrend, fill_gaps, process


def hermite(x):
    """Gap filling, gap by gap and sample by sample."""
    x, out, n = list(x), list(x), len(x)
    known = [i for i, v in enumerate(x) if v == v]
    for lo, hi in zip(known, known[1:], strict=False):
        d = hi - lo
        m0 = (x[hi] - x[lo - 1]) / (d + 1) if lo else (x[hi] - x[lo]) / d
        m1 = (x[hi + 1] - x[lo]) / (d + 1) if hi + 1 < n else (x[hi] - x[lo]) / d
        for i in range(lo + 1, hi):
            # The cubic through both ends with these slopes, by its divided differences.
            s = (x[hi] - x[lo]) / d
            u, v = i - lo, i - hi
            out[i] = x[lo] + m0 * u + (s - m0) / d * u * u + (m1 + m0 - 2 * s) / (d * d) * u * u * v
    return np.array(out)


@pytest.mark.parametrize("seed", range(4))
def test_gap_filling_of_random_series(seed):
    rng = np.random.default_rng(seed)
    for _ in range(200):
        x = rng.normal(size=rng.integers(1, 60)).cumsum()
        x[rng.random(len(x)) < rng.choice([0.1, 0.4, 0.8])] = np.nan
        got = fill_gaps(x)
        assert np.allclose(got, hermite(x), equal_nan=True) and np.array_equal(got[~np.isnan(x)], x[~np.isnan(x)])


def test_a_cubic_is_filled_between_slopes_and_ends_stay():
    t = np.arange(40.0)
    x = 3 - 2 * t + 0.5 * t * t
    holes = x.copy()
    holes[[0, 12, 30, 31, 38, 39]] = np.nan
    filled = fill_gaps(holes)
    assert abs(filled[12] - x[12]) < 0.3 and np.abs(filled[30:32] - x[30:32]).max() < 0.8
    assert np.flatnonzero(np.isnan(filled)).tolist() == [0, 38, 39]
    line = 7 - 0.25 * t
    line[5:25] = np.nan
    assert np.abs(fill_gaps(line) - (7 - 0.25 * t)).max() < 1e-12


def test_gaps_beside_an_isolated_sample_stay():
    x = np.array([1, 2, np.nan, 4, np.nan, 6, 7])
    assert np.array_equal(fill_gaps(x), x, equal_nan=True)


def test_detrend():
    rng = np.random.default_rng(2)
    for n in (2, 3, 50, 400):
        x = rng.normal(size=n) * 10 + rng.normal() * np.arange(n)
        x[rng.random(n) < 0.3] = np.nan
        ok = np.flatnonzero(~np.isnan(x))
        out = detrend(x)
        assert np.array_equal(np.isnan(out), np.isnan(x))
        if len(ok) > 1:
            slope, level = np.polyfit(ok, x[ok], 1)
            assert np.allclose(out[ok], x[ok] - slope * ok - level, atol=1e-8)
    assert detrend(np.array([3.0, np.nan])).tolist()[0] == 0.0  # its mean is itself
    assert detrend(np.array([3.0])).tolist() == [3.0] and np.isnan(detrend(np.full(4, np.nan))).all()


def test_bandpass_keeps_the_band_without_shift():
    fs, t = 100, np.arange(60_000) / 100
    inside, outside = np.sin(2 * np.pi * 0.45 * t), np.sin(2 * np.pi * 10 * t)
    out = bandpass(inside + outside, fs, 0.1, 2.0)[20_000:40_000]
    assert np.abs(out - inside[20_000:40_000]).max() < 0.01
    edge = bandpass(np.sin(2 * np.pi * 2.0 * t), fs, 0.1, 2.0)[20_000:40_000]
    assert abs(np.abs(edge).max() - 0.5) < 0.01  # half power twice
    assert np.isnan(bandpass(np.full(10, np.nan), fs, 0.1, 2.0)).all()


def test_process_decimates_from_the_skip():
    assert len(process(np.full(103, np.nan), 100, 0.1, 2, 5, 3)) == 20
    assert len(process(np.sin(np.arange(1000) / 80), 100, 1, 2, 20, 7)) == 50


def test_planner_keeps_every_sample_that_is_not_late():
    rng = random.Random(4)
    for _ in range(200):
        p = Planner(1.0, 2, block_s=50, slack_s=10, context_s=8, reset_s=100)
        t, blocks, placed = 0.0, [], []
        for _ in range(rng.randint(1, 60)):
            t += rng.choice([0, 1, 5, 20, 300])
            n = rng.randint(0, 30)
            at, closed = p.add(t, n)
            blocks += closed
            if at is not None:
                placed.append((*at, n))
        blocks += p.drain()
        ends = {}
        for b in blocks:
            assert b.offset == ends.get("end", 0) and 0 < b.take <= 50 and (b.offset + b.phase) % 2 == 0
            ends["end"] = b.offset + b.take
        for segment, place, n in placed:
            own = [b for b in blocks if b.segment == segment]
            assert own[0].offset <= place and place + n <= own[-1].offset + own[-1].take


def test_index_checks():
    assert check_index([100.0, 100.0, 0.0], "ENZ") == 100.0
    with pytest.raises(ValueError, match="Mixed"):
        check_index([100.0, 50.0], "ENZ")
    with pytest.raises(ValueError, match="component Z"):
        check_index([100.0], "EN")


def test_configuration():
    assert Config().problems() == [] and (Config().win_size, Config().step_size) == (1000, 250)
    assert Config().average_lengths(5.0) == (2, 300)
    assert "Nyquist" in Config(freqmax=2.5).problems()[0]
    assert len(Config(freqmin=-1, win_sec=0).problems()) == 2
    assert Config(fs=30).rate_warning(100.0) and not Config(fs=5).rate_warning(100.0)
    assert Config.load("/nowhere") == Config()


def test_kernels_against_loops():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(5, 64)).cumsum(axis=1)
    out = kernels.single(x, 5.0, 2, 30)
    for k, row in enumerate(x):
        z = (row - row.mean()) / row.std()
        p = np.abs(np.fft.fft(z))[:33] ** 2 / 64
        f = np.arange(33) * 5 / 64
        assert np.isclose(out["DOMINANT_FREQ"][k], f[1:][p[1:].argmax()])
        assert np.isclose(out["LOW_FREQ_ENERGY"][k] + out["HIGH_FREQ_ENERGY"][k], 1)
        r = [np.mean(z[i - 1 : i + 1] ** 2) / np.mean(z[i - 29 : i + 1] ** 2) for i in range(29, 64)]
        assert np.allclose([out["STA_LTA_Max"][k], out["STA_LTA_Mean"][k], out["STA_LTA_Median"][k]], [max(r), np.mean(r), np.median(r)])
        d = [row[1] - row[0], row[2] - row[0], *np.diff(row)[2:]]
        dd = [row[2] - row[1], (row[3] - row[2]) - (row[2] - row[0]), *np.diff(np.diff(row))[2:]]
        mobility = np.sqrt(np.var(d) / np.var(row))
        assert np.isclose(out["HJORTH_MOBILITY"][k], mobility) and np.isclose(out["HJORTH_COMPLEXITY"][k], np.sqrt(np.var(dd) / np.var(d)) / mobility)
        assert np.isclose(out["ZCR"][k], sum((a >= 0) != (b >= 0) for a, b in zip(row, row[1:], strict=False)) / 63)


def test_windows_with_a_missing_sample_and_flat_windows():
    x = np.zeros((3, 64))
    x[0] = np.arange(64)
    x[1, 5] = np.nan
    out = kernels.features(x, x, x, 5.0, 2, 30)
    assert len(out) == 51 and np.isnan(out["E_RMS"][1]) and np.isnan(out["EN_CROSS_CORR"][1:]).all() and np.isclose(out["EN_CROSS_CORR"][0], 1)
    assert out["E_RMS"][2] == 0 and np.isnan(out["E_SKEWNESS"][2]) and out["E_HJORTH_MOBILITY"][2] == 0 and np.isnan(out["E_STA_LTA_Max"][2])


def test_small_groups_are_computed_as_one_matrix(spark):
    from tremor.plans.pipeline import windows

    rows = [(s, 1, 0, 0.0, 1.0 if s < 30 else 2.0, *[[float(s * 100 + i) for i in range(8)]] * 3) for s in range(40)]
    pieces = spark.createDataFrame(rows, "station bigint, run bigint, pos bigint, start_epoch double, fs double, e array<double>, n array<double>, z array<double>").coalesce(1)
    values = lambda e, n, z, fs: {"size": np.full(len(e), float(len(e))), "first": e[:, 0], "last": z[:, -1], "fs": np.full(len(e), fs)}
    found = windows(pieces, 4, 2, values, "size double, first double, last double, fs double").collect()
    assert sorted((r.station, r.w, r.end_epoch, r.first, r.last, r.fs) for r in found) == [(s, w, (2 * w + 4) / (f := 1.0 if s < 30 else 2.0), s * 100.0 + 2 * w, s * 100.0 + 2 * w + 3, f) for s in range(40) for w in range(3)]
    assert max(r["size"] for r in found) > 3  # a station has a group of three windows
