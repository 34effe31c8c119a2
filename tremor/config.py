"""Run configuration: parameters, derived lengths, checks."""

from __future__ import annotations

import json
import logging
from dataclasses import asdict, dataclass, replace

log = logging.getLogger("tremor")

#: Seconds of a block, of slack before a block is closed, of context before a block, and of a pause after which the clock starts anew. Fixed values.
BLOCK_S, SLACK_S, CONTEXT_S, RESET_S = 3600.0, 60.0, 120.0, 7200.0


@dataclass(frozen=True)
class Config:
    station: str = "ELZG"
    fs: float = 5.0
    win_sec: float = 200
    step_sec: float = 50
    sta_sec: float = 0.5
    lta_sec: float = 60
    freqmin: float = 0.1
    freqmax: float = 2.0

    @property
    def win_size(self) -> int:
        return int(self.win_sec * self.fs)

    @property
    def step_size(self) -> int:
        return int(self.step_sec * self.fs)

    def average_lengths(self, fs: float) -> tuple[int, int]:
        """Samples of the short and of the long average; the rate is truncated first for the long one."""
        return int(self.sta_sec * fs), int(self.lta_sec * int(fs))

    def decimation(self, native: float) -> tuple[int, float]:
        factor = max(1, int(native / self.fs))
        return factor, native / factor

    def problems(self, native: float | None = None) -> list[str]:
        """All reasons not to run; nearness to Nyquist is only logged."""
        if not self.fs > 0:
            return [f"fs must be positive, not {self.fs}"]
        found = []
        if not 0 < self.freqmin < self.freqmax:
            found.append(f"need 0 < freqmin < freqmax, not {self.freqmin} and {self.freqmax}")
        nyquist = self.fs / 2
        if self.freqmax >= nyquist:
            found.append(f"freqmax {self.freqmax} is not below the output Nyquist frequency {nyquist}")
        elif self.freqmax > 0.9 * nyquist:
            log.warning("freqmax %s is within 10 %% of the output Nyquist frequency %s", self.freqmax, nyquist)
        if self.win_size < 1 or self.step_size < 1:
            found.append("win_sec and step_sec must hold a sample at least")
        nsta, nlta = self.average_lengths(self.fs)
        if not 0 < nsta <= nlta:
            found.append(f"need 0 < short average <= long average, not {nsta} and {nlta} samples")
        if native is not None and self.freqmax >= native / 2:
            found.append(f"freqmax {self.freqmax} is not below the native Nyquist frequency {native / 2}")
        return found

    def rate_warning(self, native: float) -> str | None:
        """Decimation is by a whole factor, so the output rate may not be the one asked for."""
        actual = self.decimation(native)[1]
        return f"output rate is {actual}, not {self.fs}: {native} is no whole multiple of it" if abs(actual - self.fs) > 1e-9 else None

    @classmethod
    def load(cls, path: str | None) -> Config:
        """From JSON; all defaults, with a warning, if the file can't be read or lacks a field. Unknown fields are ignored."""
        if path is None:
            return cls()
        try:
            with open(path) as f:
                raw = json.load(f)
            return cls(**{k: raw[k] for k in asdict(cls())})
        except (OSError, ValueError, KeyError, TypeError) as e:
            log.warning("default configuration: %s can't be used (%s)", path, e)
            return cls()

    def override(self, **values) -> Config:
        return replace(self, **{k: v for k, v in values.items() if v is not None})

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=2)
