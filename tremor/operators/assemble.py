"""From record metadata to blocks: order, grid places, late records, watermark, pauses."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np

from tremor.config import BLOCK_S, CONTEXT_S, RESET_S, SLACK_S
from tremor.functions.kernels import COMPONENTS


@dataclass
class Block:
    """``take`` samples from ``start`` on; ``offset`` of the first in the whole stream; ``lead`` samples of the block before serve as context; the first ``phase`` samples precede the decimation grid."""

    segment: int
    number: int
    start: float
    offset: int
    take: int
    lead: int
    phase: int


@dataclass
class Planner:
    """Sequential rules of assembly. ``add`` takes records in the order of (start, file, offset) and returns where each goes and what blocks it closes.

    It needs record metadata only, and its state is a few numbers, so one task can plan a station of any length.
    """

    fs: float
    factor: int = 1
    block_s: float = BLOCK_S
    slack_s: float = SLACK_S
    context_s: float = CONTEXT_S
    reset_s: float = RESET_S
    start: float | None = None
    watermark: float = -np.inf
    filled: int = 0
    offset: int = 0
    lead: int = 0
    segment: int = 0
    number: int = 0
    dropped: int = 0
    ends: dict[str, int] = field(default_factory=dict)

    def _close(self, length: int) -> Block:
        take = min(length, self.filled)
        block = Block(self.segment, self.number, self.start, self.offset, take, self.lead, -self.offset % self.factor)
        self.filled -= take
        self.start += take / self.fs
        self.offset += take
        self.lead = min(int(self.context_s * self.fs), take)
        self.number += 1
        return block

    def drain(self) -> list[Block]:
        out = []
        while self.filled > 0:
            out.append(self._close(round(self.block_s * self.fs)))
        return out

    def add(self, start: float, count: int) -> tuple[tuple[int, int] | None, list[Block]]:
        """((segment, place of the first sample in the stream) or None if late or empty, blocks closed). Blocks closed by a pause come before the record's own."""
        closed: list[Block] = []
        if count <= 0:
            return None, closed
        if self.start is None:
            self.start = start
        if start - self.start > self.reset_s:
            closed += self.drain()
            self.segment += 1
            self.start, self.watermark, self.lead = start, -np.inf, 0
        shift = (start - self.start) * self.fs
        place = int(np.floor(abs(shift) + 0.5) * np.sign(shift))
        if place < 0:
            self.dropped += 1
            at = None
        else:
            self.filled = max(self.filled, place + count)
            at = (self.segment, self.offset + place)
            self.watermark = max(self.watermark, start + (count - 1) / self.fs)
        while self.watermark >= self.start + self.block_s + self.slack_s and self.filled > 0:
            closed.append(self._close(round(self.block_s * self.fs)))
        return at, closed


def check_index(rates: Iterable[float], components: Iterable[str]) -> float:
    """The one rate of an archive; raises if rates differ by more than 1e-6 or a component is missing."""
    rates = [r for r in rates if r > 0]
    if not rates or max(rates) - min(rates) > 1e-6:
        raise ValueError(f"Mixed sample rates: {sorted(set(rates))}" if rates else "No records")
    missing = [c for c in COMPONENTS if c not in set(components)]
    if missing:
        raise ValueError(f"No data for component {', '.join(missing)}")
    return rates[0]
