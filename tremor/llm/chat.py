"""Chat formatting: a hidden Markov model recovers the roles of transcript lines, then turns are rendered.

States are roles. A line shows its speaker marker (``User:``, ``Assistant:``, ``System:`` and the like), whether a turn of the source starts with it, its
length, and whether it asks. Step rates are those of lines that start a turn of the source, or of lines within one. All rates are counted by Spark over the labelled lines of conversations that are not held out.
Viterbi's algorithm decodes each conversation; lines go out as soon as all its surviving paths agree on them, so a very long conversation is
not held as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm.common import HELD_OUT, cut, only_columns, row_hash, tidy

ROLES = ["system", "user", "assistant"]
#: Order of the lines of a conversation: rows that repeat a turn follow one another by a hash of what they hold; row only keeps the lines of equal rows together.
ORDER = ["turn", "key", "row", "at"]
MARKERS = {"system": r"system|sys|instruction|context", "user": r"user|human|customer|question|q|prompt|you", "assistant": r"assistant|ai|bot|agent|answer|a|model|response"}
_MARK = r"(?i)^\s*(?:\*\*|#+\s*|<\|?|\[)?\s*(%s)\s*(?:\|?>|\]|\*\*)?\s*[:>：]\s*"
LENGTHS = 6
#: Codes from FIRST on are those of lines that start a turn of the source.
FIRST, CODES = 4 * LENGTHS * 2, 2 * 4 * LENGTHS * 2
#: Lines after which agreement of the surviving paths is looked for.
AGREE_EVERY = 64


def marker(line: Column) -> Column:
    """0 for no marker, 1 to 3 for one of the roles."""
    out = F.lit(0)
    for k, role in enumerate(ROLES):
        out = F.when(F.rlike(line, F.lit(_MARK % MARKERS[role])), F.lit(k + 1)).otherwise(out)
    return out


def lines_of(turns: DataFrame) -> DataFrame:
    """conv_id, turn, key and row (which row of the turn), at (line of the row), line, role (place in ROLES or null), obs (code of what the line shows). A null text is one empty line."""
    rows = turns.select("conv_id", "turn", row_hash("role", "text").alias("key"), F.monotonically_increasing_id().alias("row"), F.lower("role").alias("role"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("at", "line"))
    size = F.least(F.floor(F.log2(F.length("line") + 1) / 2).cast("int"), F.lit(LENGTHS - 1))
    obs = (((F.col("at") == 0).cast("int") * 4 + marker(F.col("line"))) * LENGTHS + size) * 2 + F.rlike("line", F.lit(r"\?\s*$")).cast("int")
    role = F.when(F.col("role").isin(ROLES), F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")).cast("int") - 1)
    return rows.select("conv_id", "turn", "key", "row", "at", "line", role.alias("role"), obs.alias("obs"))


@dataclass
class Model:
    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray


def fit(lines: DataFrame) -> Model:
    """Log rates with a count added to each; without labels markers alone tell the roles apart. Counts are of fixed size; they are gathered where the lines are sorted anyway."""
    k = len(ROLES)
    learned = lines.where(F.col("conv_id").isNotNull() & (F.crc32(F.col("conv_id").cast("string")) % 4 != HELD_OUT))
    order = Window.partitionBy("conv_id").orderBy(*ORDER)
    pairs = learned.select("role", "obs", F.lag("role", 1, -1).over(order).alias("before")).where("role is not null").groupBy("before", "role", "obs").count().collect()
    start, step, emit = np.ones(k), np.stack([np.ones((k, k)) + 20 * np.eye(k), np.ones((k, k))]), np.full((k, CODES), 0.05)
    code = np.arange(CODES) // 2 // LENGTHS % 4
    for r in range(k):
        emit[r] += np.where(code == r + 1, 20.0, 0.0)
    for r in pairs:
        emit[r.role, r.obs] += r["count"]
        if r.before is not None:
            (start if r.before < 0 else step[r.obs // FIRST, r.before])[r.role] += r["count"]
    return Model(np.log(start / start.sum()), np.log(step / step.sum(axis=2, keepdims=True)), np.log(emit / emit.sum(axis=1, keepdims=True)))


class Path:
    """Viterbi over a stream; ``add`` and ``end`` return the states that are certain by then, in order. Ties go to the first role."""

    def __init__(self, model: Model):
        self.model, self.score, self.back = model, None, []

    def add(self, obs: int) -> list[int]:
        emit = self.model.emit[:, obs]
        if self.score is None:
            self.score = self.model.start + emit
            self.back.append(np.zeros(len(emit), np.int8))
            return []
        ways = self.score[:, None] + self.model.step[obs // FIRST]
        from_ = ways.argmax(axis=0)
        self.score = ways[from_, np.arange(len(emit))] + emit
        self.score -= self.score.max()
        self.back.append(from_.astype(np.int8))
        return self._agreed() if len(self.back) % AGREE_EVERY == 0 else []

    def _agreed(self) -> list[int]:
        alive = np.arange(len(self.score))
        for t in range(len(self.back) - 1, 0, -1):
            alive = np.unique(self.back[t][alive])
            if len(alive) == 1:
                out = self._trace(int(alive[0]), t - 1)
                self.back = self.back[t:]
                return out
        return []

    def _trace(self, state: int, last: int) -> list[int]:
        out = [state]
        for t in range(last, 0, -1):
            state = int(self.back[t][state])
            out.append(state)
        return out[::-1]

    def end(self) -> list[int]:
        return self._trace(int(self.score.argmax()), len(self.back) - 1) if self.back else []


def parse(turns: DataFrame) -> DataFrame:
    """Canonical turns: conv_id, turn (0, 1, ..), role, n_lines, text, rendered.

    A run of lines of one role is a turn; markers at the start of lines are dropped; rendered is ``<|role|>\\n text \\n<|end|>``. Lines are in the order
    of (turn, row, line); null turns come first. Rows that repeat a turn follow one another whole, by a hash of what they hold. Rows with a null conv_id belong to one conversation
    without id, which may be of any type. Texts of any length are taken whole.
    The roles of the input are learned from (where crc32 of the conversation's id modulo 4 is not 2), never read for decoding. No rows, no turns.
    """
    lines = cut(lines_of(only_columns(turns, "conv_id", "turn", "role", "text")))
    model = fit(lines)
    strip = F.regexp_replace("line", _MARK % "|".join(MARKERS.values()), "")
    kind = dict(turns.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        arrow_kind = None
        conv, path, held, turn, role, text = object(), None, [], 0, None, []

        def close():
            nonlocal turn, text
            if text:
                whole = "\n".join(text).strip("\n")
                out.append((conv, turn, ROLES[role], len(text), whole, f"<|{ROLES[role]}|>\n{whole}\n<|end|>"))
                turn, text = turn + 1, []

        def take(states: list[int]):
            nonlocal role, held
            for s, line in zip(states, held, strict=False):
                if s != role:
                    close()
                    role = s
                text.append(line)
            held = held[len(states) :]

        def batch():
            cols = list(zip(*out, strict=True)) or [[]] * 6
            out.clear()
            kinds = [arrow_kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["conv_id", "turn", "role", "n_lines", "text", "rendered"])

        for b in batches:
            arrow_kind = b.schema.field(0).type
            for c, obs, line in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if path is None or c != conv:
                    if path is not None:
                        take(path.end())
                        close()
                    conv, path, held, turn, role, text = c, Path(model), [], 0, None, []
                held.append(line)
                take(path.add(obs))
            if out:
                yield batch()
        if path is not None:
            take(path.end())
            close()
            yield batch()

    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER).select("conv_id", "obs", strip.alias("line"))
    return ordered.mapInArrow(tidy(run), f"conv_id {kind}, turn long, role string, n_lines long, text string, rendered string")
