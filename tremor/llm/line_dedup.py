"""Removal of fuzzy duplicate lines across all documents.

A line's shingles are the ``GRAM`` characters from each of its characters on, in all scripts and whatever the words (a shorter line is one shingle).
Minimum hashes of them (``minhash``) form bands, and lines that share a band are compared: first each with the least of its bucket; then, in every
bucket, all pairs that these ties did not join into one component. A sketch of one bit of each minimum sorts out pairs that are far from similar, exact
Jaccard similarity of the sets of shingles (52-bit hashes within a pair) confirms the others, and of each component of confirmed pairs (distributed
union-find) the first line stays.

Equal lines are one node all along: each distinct line is hashed once, and a line that a third of all documents share is counted before
it is shuffled. Two lines of similarity s share none of ``BANDS`` bands of ``ROWS`` minima with probability (1 - s^ROWS)^BANDS: 0.6 % at 0.8, 0.03 % at 0.85,
for short lines as for long ones.

Lines are split, counted, dealt out and joined by DataFrame operations; signatures and confirmation are vectorised Python over Arrow, since a wholly
native form did not fit its limits (README).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm import minhash
from tremor.llm.common import cut, drop, gathered, row_hash, tidy, wrapped
from tremor.llm.graph import components

GRAM, BANDS, ROWS, SIMILARITY = 5, 17, 6, 0.8
#: Lines of a bucket that are paired in one group; larger buckets are dealt out as pairs of such blocks.
BLOCK = 512


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, doc (hash of id and text), text."""
    return docs.select("doc_id", row_hash("doc_id", "text").alias("doc"), "text")


def _normal(raw: Column) -> Column:
    return F.lower(F.trim(raw, F.lit(" \t\r\f\x0b")))


def signed(lines: DataFrame) -> DataFrame:
    """line, norm, f, g (sketch) and bands (array of their hashes) of each distinct ``line`` that is not blank; ``lines``: line, norm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gathered(batches, "norm"):
            b = b.filter(pc.not_equal(b.column(1), ""))
            low = minhash.signatures(b.column(1), GRAM, BANDS * ROWS)
            f, g = minhash.sketch(low)
            ends = pa.array(np.arange(0, BANDS * (len(low) + 1), BANDS, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(f), pa.array(g), pa.ListArray.from_arrays(ends, pa.array(minhash.bands(low, BANDS).ravel()))], names=["line", "norm", "f", "g", "bands"])

    return lines.groupBy("line").agg(F.max("norm").alias("norm")).mapInArrow(tidy(run), "line long, norm string, f long, g long, bands array<long>")


def _far(similarity: float) -> Column:
    """Whether the sketches (f, g) and (v, w) are too far apart."""
    return F.bit_count(F.col("f").bitwiseXOR(F.col("v"))) + F.bit_count(F.col("g").bitwiseXOR(F.col("w"))) > minhash.most_bits(BANDS * ROWS, similarity)


def _confirm(pairs: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` (a, b) of lines whose sets of shingles are similar; ``known``: line, norm, f, g."""
    most = 1 << minhash.PAIR_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in gathered(batches, "x"):
            for at in range(0, whole.num_rows, most):
                b = whole.slice(at, most)
                common, union = minhash.overlaps(b.column(2), b.column(3), GRAM)
                yield b.select(["a", "b"]).filter(pa.array(common >= similarity * union - 1e-9))

    both = pairs.join(known.select(F.col("line").alias("a"), F.col("norm").alias("x"), "f", "g"), "a")
    both = both.join(known.select(F.col("line").alias("b"), F.col("norm").alias("y"), F.col("f").alias("v"), F.col("g").alias("w")), "b")
    return both.where(~_far(similarity)).select("a", "b", "x", "y").mapInArrow(tidy(run), "a long, b long")


def _others(members: DataFrame, roots: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links between similar lines of a bucket that stand in different components of ``roots``, as many as join those. ``members``: band, line, least; its least line has been compared.

    A bucket goes to a task, a large one is dealt out as pairs of blocks of ``BLOCK`` lines; no pairs leave it but links. Of buckets of the same lines one is enough.
    """
    rows = members.where("line <> least").join(roots.toDF("line", "root"), "line", "left").select("band", "line", F.coalesce("root", "line").alias("root"))
    seen = [F.min("line").alias("least"), F.max("line").alias("most"), F.bit_xor("line").alias("x"), F.count("*").alias("n")]
    open_ = rows.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), *seen).where("low < high")
    open_ = open_.groupBy("least", "most", "x", "n").agg(F.min("band").alias("band"))
    rows = rows.join(open_.select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "band")
    rows = rows.select("band", "line", "root", F.pmod(F.xxhash64("line"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    side = F.when(F.col("block") == F.col("with"), 2).when(F.col("block") < F.col("with"), 0).otherwise(1)
    rows = rows.select("band", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), side.alias("side"), "line", "root")
    dealt = rows.join(known, "line").select("band", "lo", "hi", "side", "line", "root", "f", "g", "norm").repartition("band", "lo", "hi").sortWithinPartitions("band", "lo", "hi")
    most = minhash.most_bits(BANDS * ROWS, similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def flush():
            b = pa.concat_batches(held)
            line, root, f, g = (b.column(k).to_numpy() for k in (4, 5, 6, 7))
            links = minhash.joined(b.column(8), f, g, root, b.column(3).to_numpy(), GRAM, most, similarity)
            return pa.RecordBatch.from_arrays([pa.array([line[i] for i, _ in links], pa.int64()), pa.array([line[j] for _, j in links], pa.int64())], names=["a", "b"])

        for b in batches:
            keys = np.stack([c.to_numpy().astype(np.int64) for c in b.columns[:3]], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                now = tuple(keys[lo]) if hi > lo else key
                if now != key and held:
                    yield flush()
                    held = []
                key = now
                if hi > lo:
                    held.append(b.slice(lo, hi - lo))
        if held:
            yield flush()

    return dealt.mapInArrow(tidy(run), "a long, b long").distinct()


def groups(lines: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(line, root) of each line of ``lines`` (line, norm) that is similar to another one; root is the least hash of the component."""
    known = cut(signed(lines))
    bucket = Window.partitionBy("band")
    rows = known.select("line", F.explode("bands").alias("band")).select("band", "line", F.min("line").over(bucket).alias("least"), F.max("line").over(bucket).alias("most"))
    members = cut(rows.where("least < most").select("band", "line", "least"))
    pairs = cut(members.where("line <> least").select(F.col("least").alias("a"), F.col("line").alias("b")).distinct())
    texts = cut(known.select("line", "norm", "f", "g").join(members.select("line").distinct(), "line", "left_semi"))
    drop(known)
    alike = cut(_confirm(pairs, texts, similarity))
    roots = components(alike)
    more = cut(_others(members, roots, texts, similarity))
    drop(members, pairs, texts)
    return (roots if more.isEmpty() else components(alike.union(more))).toDF("line", "root")


def duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(places, lost): doc_id, doc, at, line (hash of the trimmed line in lower case; null for a blank one) of each line; doc and at of the lines that go.

    Of a component of similar lines the one of least (doc_id, doc, at) stays.
    """
    split = _rows(docs).select("doc_id", "doc", F.posexplode_outer(F.split("text", "\n")).alias("at", "raw")).select("doc_id", "doc", "at", _normal(F.col("raw")).alias("norm"))
    places = cut(split.select("doc_id", "doc", "at", F.when(F.col("norm") != "", F.xxhash64("norm")).alias("line")))
    lines = docs.select(F.explode(F.split("text", "\n")).alias("raw")).select(_normal(F.col("raw")).alias("norm"))
    roots = groups(lines.select(F.xxhash64("norm").alias("line"), "norm"), similarity)
    counted = places.where("line is not null").groupBy("line").agg(F.min(F.struct("doc_id", "doc", "at")).alias("first"), F.count("*").alias("n"))
    some = cut(counted.join(roots, "line", "left").where("n > 1 or root is not null").select("line", F.coalesce("root", "line").alias("root"), "first"))
    first = some.groupBy("root").agg(F.min("first").alias("first"))
    marked = some.select("line", "root").join(first, "root").select("line", F.col("first.doc").alias("own"), F.col("first.at").alias("where"))
    lost = places.join(marked, "line").where("doc <> own or at <> where").select("doc", "at")
    return places, lost


def line_counts(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, n_lines (lines that are not blank), n_kept, removed_at (ascending places of removed lines among all lines, as text).

    A null text has no lines. Rows that repeat an id and a text are one document; rows that only repeat an id are documents of their own. Blank lines are no
    duplicates of each other. Only doc_id and text are looked at, whatever the other columns are called.
    """
    places, lost = duplicates(docs.select(F.col("`doc_id`"), F.col("`text`")), similarity)
    gone = lost.groupBy("doc").agg(F.sort_array(F.collect_set("at")).alias("lost"))
    # Every row has one line at place 0 (or none at all), so counts of repeated rows are multiples.
    first = F.coalesce(F.col("at"), F.lit(0)) == 0
    counted = places.groupBy("doc").agg(F.count_if(first).alias("rows"), F.count("line").alias("lines"))
    rows = places.where(first).select("doc_id", "doc").join(counted, "doc").join(gone, "doc", "left")
    n = F.expr("lines div rows")
    return rows.select("doc_id", n.alias("n_lines"), (n - F.coalesce(F.size("lost"), F.lit(0))).alias("n_kept"), F.coalesce(F.array_join(F.col("lost").cast("array<string>"), ","), F.lit("")).alias("removed_at"))


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without duplicate lines, all columns as they were but ``text``. A document all of whose lines stand in others is dropped; one that had none stays."""
    _, lost = duplicates(docs.select(F.col("`doc_id`"), F.col("`text`")), similarity)
    gone = lost.groupBy("doc").agg(F.collect_set("at").alias("lost"))
    rows = wrapped(docs, F.col("`text`").alias("old"), row_hash("doc_id", "text").alias("doc")).join(gone, "doc", "left")
    places = lambda parts: F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("lost"))
    left = F.transform(F.array(F.split("old", "\n")), lambda parts: F.transform(places(parts), lambda i: F.get(parts, i)))
    new = F.when(F.col("lost").isNull(), F.col("old")).otherwise(F.array_join(F.get(left, F.lit(0)), "\n"))
    kept = rows.select("row", "lost", new.alias("new")).where(F.col("lost").isNull() | (F.trim("new", F.lit(" \t\r\f\x0b\n")) != ""))
    return kept.select(*[F.col("new" if c == "text" else f"row.c{k}").alias(c) for k, c in enumerate(docs.columns)])
