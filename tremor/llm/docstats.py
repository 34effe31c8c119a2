"""Statistics of whole texts, counted over byte buffers of many documents at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tremor.llm.common import pieces, text_buffers, tidy
from tremor.llm.textvec import SPACED, Words, byte_class, repeated, span_hashes, sums

SYMBOLS = np.zeros(256, bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_CONTINUED = byte_class((0x80, 0xBF))
_DIGIT, _UPPER, _PUNCT = byte_class((48, 57)), byte_class((65, 90)), byte_class((33, 47), (58, 64), (91, 96), (123, 126))
_STOPS, _PIPE = byte_class((33, 33), (46, 46), (63, 63)), byte_class((124, 124))

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [
    "log_words", "mean_word", "symbols_per_word", "symbol_words", "dup_lines", "repeat_words", "log_line", "short_lines", "digits", "capitals", "punctuation", "full_stops",
    "pipes", "distinct_words", "top_word", "word_spread", "long_words", "beyond_ascii", "log_lines", "blank_lines",
]


def stats_of(buf: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """(counts, features) of texts in one buffer; words are ``[^\\x20\\x09-\\x0D]+``. A text without words has zeros."""
    w = Words(buf, offsets, SPACED)
    buf, offsets, docs = w.buf, w.offsets, w.docs
    n = w.counts
    per = lambda kind: sums(kind[buf], offsets)
    inside = sums(~_CONTINUED[buf] & SPACED[buf], offsets)
    size = (w.ends - w.starts).astype(np.int64)
    symbols = per(SYMBOLS)

    hashes = w.hashes(lower=False)
    order, again = repeated(w.doc, hashes)
    distinct = np.bincount(w.doc[order][~again], minlength=docs)
    runs = np.diff(np.append(np.flatnonzero(~again), len(order)))
    top = np.zeros(docs, np.int64)
    np.maximum.at(top, w.doc[order][~again], runs)

    triples, at = w.windows(hashes, 3)
    order, again = repeated(w.doc[at], triples)
    twice = again.copy()
    twice[:-1] |= again[1:]
    where = at[order[twice]]
    covered = np.zeros(len(hashes), bool)
    for j in range(3):
        covered[where + j] = True
    repeats = np.bincount(w.doc[covered], minlength=docs)

    newline = np.flatnonzero(buf == 10)
    starts = np.unique(np.concatenate([offsets[:-1], newline + 1]))
    starts = starts[starts < len(buf)]
    line_doc = np.searchsorted(offsets, starts, "right") - 1
    ends = np.minimum(np.append(newline, len(buf))[np.searchsorted(newline, starts)] if len(starts) else starts, offsets[line_doc + 1])
    words = np.searchsorted(w.starts, ends) - np.searchsorted(w.starts, starts)
    full = words > 0
    order, again = repeated(line_doc[full], span_hashes(buf, starts[full], ends[full]))
    dups = np.bincount(line_doc[full][order][again], minlength=docs)
    lines = np.bincount(line_doc, minlength=docs)
    filled = np.bincount(line_doc[full], minlength=docs)
    short = np.bincount(line_doc[full][words[full] < 5], minlength=docs)

    some, chars, some_lines = np.maximum(n, 1), np.maximum(inside, 1), np.maximum(filled, 1)
    marks = np.concatenate([[0], np.cumsum(SYMBOLS[buf])])
    marked = np.bincount(w.doc[marks[w.ends] > marks[w.starts]], minlength=docs)
    square = np.bincount(w.doc, weights=size.astype(float) ** 2, minlength=docs)
    total = np.bincount(w.doc, weights=size.astype(float), minlength=docs)
    features = np.stack(
        [
            np.log1p(n), inside / some, symbols / some, marked / some, dups / some_lines, repeats / some, np.log1p(n / some_lines), short / some_lines, per(_DIGIT) / chars, per(_UPPER) / chars,
            per(_PUNCT) / chars, per(_STOPS) / some, per(_PIPE) / some, distinct / some, top / some, np.sqrt(np.maximum(0, square / some - (total / some) ** 2)), np.bincount(w.doc[size > 16], minlength=docs) / some,
            (total - per(byte_class((0, 127))) + sums(~SPACED[buf], offsets)) / chars, np.log1p(filled), (lines - filled) / np.maximum(lines, 1),
        ],
        axis=1,
    )
    return {"n_words": n, "word_chars": inside, "n_symbols": symbols, "n_dup_lines": dups, "n_repeat_words": repeats}, features


def document_stats(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` of each row of ``docs`` with its counts (long) and ``features`` (array of double). Windows and lines are compared by 64-bit hashes within a document."""
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            counts, features = stats_of(*text_buffers(batch.column(batch.schema.get_field_index("text"))))
            flat = pa.array(np.ascontiguousarray(features, dtype=np.float64).ravel())
            ends = pa.array(np.arange(0, features.size + 1, features.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(k)) for k in keys), *(pa.array(counts[c].astype(np.int64)) for c in COUNTS), pa.ListArray.from_arrays(ends, flat)], names=[*keys, *COUNTS, "features"]
            )

    fields = [*(f"`{k}` {kinds[k]}" for k in keys), *(f"{c} bigint" for c in COUNTS), "features array<double>"]
    return docs.select(*dict.fromkeys([*keys, "text"])).mapInArrow(tidy(run), ", ".join(fields))
