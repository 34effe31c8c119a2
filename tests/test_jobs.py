"""Jobs: runs over growing input, repeated and broken runs, partial renewal, command lines."""

import json
import os
import random
import subprocess
import sys

import pytest

from jobs import feature_archive, feed_triggers
from tests.conftest import ROOT

DATA = "/root/testdata/sf0.001"
CONFIG = {"cell_docs": 4, "short_cells": 2, "long_cells": 5, "block_cells": 8, "files_per_batch": 1}


def feed(seed=0, n=400):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "a", "b", None]), None if i % 17 == 0 else "x" * rng.randrange(1, 200) * (9 if i // 40 % 4 == 3 else 1)) for i in range(n) if not 200 <= i < 260]
    return rows + [(None, "a", "lost"), (3, "a", "again"), (n + 1000, "c", "far away")]


def expected(rows, c):
    """{(source, cell): (n_docs, chars, ratio, triggered)} by plain loops."""
    found = {}
    for i, source, text in rows:
        if i is not None:
            k = (source or feed_triggers.UNNAMED, i // c["cell_docs"])
            n, chars = found.get(k, (0, 0))
            found[k] = n + 1, chars + len(text or "")
    mean = lambda s, cell, n: sum(found.get((s, cell - j), (0, 0))[1] ** 2 for j in range(n)) / n
    out = {}
    for (s, cell), (n, chars) in found.items():
        far = mean(s, cell, c["long_cells"])
        ratio = None if cell < c["long_cells"] - 1 else round(mean(s, cell, c["short_cells"]) / far, 6) if far else 0.0
        out[s, cell] = n, chars, ratio, ratio is not None and ratio >= c["threshold"]
    return out


def found(df):
    return {(r.source, r.cell): (r.n_docs, r.chars, r.ratio, r.triggered) for r in df.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for k, (*counts, ratio, on) in want.items():
        assert got[k][:2] == tuple(counts) and got[k][3] == on and got[k][2] == (ratio if ratio is None else pytest.approx(ratio, abs=2e-6))


def put(spark, rows, folder, name):
    spark.createDataFrame([(i, t, "xx", s, 0) for i, s, t in rows], "doc_id long, text string, lang string, source string, n_chars int").coalesce(1).write.parquet(f"{folder}/{name}")


def test_feed_grows(spark, tmp_path):
    """A second run takes only what is new, whatever its ids; the result is that of one run over all."""
    rows = feed()
    random.Random(1).shuffle(rows)
    source, out, c = str(tmp_path / "in"), str(tmp_path / "out"), feed_triggers.checked(CONFIG)
    os.makedirs(source)
    stage = tmp_path / "stage"
    for k, part in enumerate((rows[:150], rows[150:300], rows[300:])):
        put(spark, part, stage, str(k))
    take = lambda k: [os.link(f, f"{source}/{k}-{f.name}") for f in (stage / str(k)).glob("part-*.parquet")]
    take(0)
    take(1)
    same(found(feed_triggers.run(spark, source, out, CONFIG)), expected(rows[:300], c))
    cells = lambda: {(r.batch): r.n for r in spark.read.schema(feed_triggers.CELLS).parquet(f"{out}/cells").groupBy("batch").agg({"n_docs": "sum"}).toDF("batch", "n").collect()}
    first = cells()
    assert len(first) == 2 and sum(first.values()) == len([r for r in rows[:300] if r[0] is not None])
    take(2)
    same(found(feed_triggers.run(spark, source, out, CONFIG)), expected(rows, c))
    second = cells()
    assert first.items() <= second.items() and len(second) == 3 and second[2] == len([r for r in rows[300:] if r[0] is not None])
    # Nothing new: nothing changes. A batch whose end was not noted runs again and leaves the same.
    same(found(feed_triggers.run(spark, source, out, CONFIG)), expected(rows, c))
    for name in ("2", ".2.crc"):
        os.remove(f"{out}/checkpoint/commits/{name}")
    same(found(feed_triggers.run(spark, source, out, CONFIG)), expected(rows, c))
    assert cells() == second
    same(found(feed_triggers.run(spark, source, str(tmp_path / "whole"), CONFIG | {"files_per_batch": 9})), expected(rows, c))


def test_feed_without_documents(spark, tmp_path):
    put(spark, [(None, "a", "x")], tmp_path, "in")
    assert feed_triggers.run(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect() == []
    with pytest.raises(ValueError, match="unknown settings"):
        feed_triggers.checked({"cells": 1})
    with pytest.raises(ValueError, match="long_cells"):
        feed_triggers.checked({"long_cells": 100})


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_archive_is_renewed_by_groups(spark, tmp_path):
    out = str(tmp_path / "archive")
    whole = feature_archive.run(spark, DATA, out)
    rows = sorted(map(repr, whole.collect()))
    files = lambda g: {f: os.stat(f"{out}/station_group={g}/{f}").st_mtime_ns for f in os.listdir(f"{out}/station_group={g}")}
    before = {g: files(g) for g in range(8)}
    again = feature_archive.run(spark, DATA, out, {"only_groups": [2, 5]})
    assert sorted(map(repr, again.collect())) == rows
    assert {g for g in range(8) if files(g) != before[g]} == {2, 5}
    with pytest.raises(ValueError, match="long_average"):
        feature_archive.checked({"long_average": 64})


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_command_lines(spark, tmp_path):
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2 pyspark-shell"}
    with open(tmp_path / "c.json", "w") as f:
        json.dump({"cell_docs": 10}, f)
    for module, table, config in (("feed_triggers", "/documents.parquet", str(tmp_path / "c.json")), ("feature_archive", "", f"{ROOT}/jobs/feature_archive.json")):
        args = ["--input", DATA + table, "--output", str(tmp_path / module), "--config", config]
        done = subprocess.run([sys.executable, "-m", f"jobs.{module}", *args], cwd=ROOT, env=env, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]
        assert "read" in done.stderr and "wrote" in done.stderr
    assert spark.read.parquet(str(tmp_path / "feed_triggers/triggers")).count() > 0 and spark.read.parquet(str(tmp_path / "feature_archive")).count() > 0
    shipped = json.load(open(f"{ROOT}/jobs/feed_triggers.json"))
    assert shipped == feed_triggers.DEFAULTS and json.load(open(f"{ROOT}/jobs/feature_archive.json")) == feature_archive.DEFAULTS
