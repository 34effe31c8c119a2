"""Ids of any type and size, nulls that are values of their own, and rows that repeat a key."""

import base64

import pytest
from pyspark.sql import functions as F

from tremor.llm import bpe, chat, line_dedup
from tremor.llm.common import row_hash


@pytest.mark.parametrize("high", [70_000, 200_000])
def test_token_ids_of_more_than_16_bits(spark, tmp_path, high):
    """A file with tokens beyond 65,535 encodes as the library does, also words of the dictionary."""
    P = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": high, b"abab": high + 1, b" c": 300, b"xy": 65_535, b"xyz": 65_536}
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(r).encode() for t, r in ranks.items()))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["abab", "ababab cab", "xyzxyabxy", "xyxyzab ab xyxyzab", "xyxyzab"] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for words in (0, 1000):
        got = bpe.decode(bpe.encode(docs, str(path), P.PATTERN, words), str(path)).collect()
        for r in got:
            assert [int.from_bytes(r.ids[i : i + 4], "little") for i in range(0, len(r.ids), 4)] == own.encode(r.text, disallowed_special=()) and bytes(r.decoded).decode() == r.text
    with pytest.raises(ValueError, match="bits"):
        bpe.PairTable({}, 19)


def test_a_null_is_no_missing_value_of_a_hash(spark):
    rows = spark.createDataFrame([("a", None), (None, "a"), ("", None), (None, ""), (None, None)], "doc_id string, text string")
    assert rows.select(row_hash("doc_id", "text")).distinct().count() == 5


def test_line_dedup_of_null_ids(spark):
    """An id with a null text and a null id with that text are two documents."""
    docs = spark.createDataFrame([("one line of text that is long enough", None), (None, "one line of text that is long enough"), ("b", "another line\nand one more line")], "doc_id string, text string")
    assert {r.doc_id: (r.n_lines, r.n_kept) for r in line_dedup.line_counts(docs).collect()} == {"one line of text that is long enough": (0, 0), None: (1, 1), "b": (2, 2)}
    assert docs.count() == line_dedup.dedup_lines(docs).count()


@pytest.mark.parametrize("kind", ["smallint", "string", "decimal(12,2)", "date"])
def test_chat_takes_ids_of_any_type_and_keeps_rows_together(spark, kind):
    rows = [("1", 0, "user", "a1\na2\na3"), ("1", 0, "user", "b1\nb2\nb3"), ("1", 0, "user", "b1\nb2\nb3"), ("1", 1, "assistant", "Assistant: yes"), ("2", 0, None, None)]
    turns = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    key = F.date_add(F.lit("2024-01-01").cast("date"), F.col("conv_id").cast("int")) if kind == "date" else F.col("conv_id").cast(kind)
    found = chat.parse(turns.withColumn("conv_id", key).repartition(3))
    assert dict(found.dtypes)["conv_id"] == kind
    out = found.collect()
    lines = [line for r in sorted(out, key=lambda r: r.turn) if str(r.conv_id).startswith(("1", "2024-01-02")) for line in r.text.split("\n")]
    assert "".join(lines) in ("a1a2a3b1b2b3b1b2b3yes", "b1b2b3b1b2b3a1a2a3yes")
    assert sum(r.n_lines for r in out) == 11
