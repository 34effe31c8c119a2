"""Plans, runs and segments in parallel against the sequential rules; scans against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from tremor.operators.assemble import Planner
from tremor.operators.scan import differences, numbered, running
from tremor.plans import planning

SECONDS = {"block_s": 64.0, "slack_s": 8.0, "context_s": 12.0, "reset_s": 128.0}
INDEX = "station string, path string, offset bigint, start_epoch double, component string, count int, fs double"


def record_set(rng, station, fs):
    """Records with small and large pauses, disorder, ties, empty and very long ones."""
    t, rows = rng.choice([0.0, 86_000.0, -50.0]), []
    calm = rng.random() < 0.4
    for k in range(rng.randint(1, 50)):
        t += rng.choice([0, 1, 5, 20]) if calm or rng.random() < 0.8 else rng.choice([57, 90, 129, 300, 5000])
        late = rng.choice([0, 0, 0, 3, 30, 90]) if not calm or rng.random() < 0.1 else 0
        count = rng.randint(0, 40) if rng.random() < 0.97 else 400
        rows.append((station, f"f{k % 3}", 100 * k, t - late + rng.choice([0, 0.125, 0.5]), rng.choice("ENZ"), count, fs))
    rng.shuffle(rows)
    return rows


def one_by_one(rows, factor):
    """{(path, offset): {(segment, block, start, first, take, lead, phase, place)} or None if late}, and the blocks."""
    p, places, blocks = Planner(rows[0][6], factor, **SECONDS), [], []
    for r in sorted(rows, key=lambda r: (r[3], r[1], r[2])):
        if r[5]:
            at, closed = p.add(r[3], r[5])
            places.append((r, at))
            blocks += closed
    blocks += p.drain()
    found = {}
    for r, at in places:
        found[r[1:3]] = None if at is None else {(b.segment, b.number, b.start, b.offset, b.take, b.lead, b.phase, at[1]) for b in blocks if b.segment == at[0] and b.offset - b.lead < at[1] + r[5] and at[1] < b.offset + b.take}
    return found, blocks


@pytest.mark.parametrize("factor", [1, 3])
def test_plans_of_random_record_sets(spark, factor):
    rng = random.Random(factor)
    sets = {f"s{k}": record_set(rng, f"s{k}", rng.choice([1.0, 2.0])) for k in range(500)}
    sets = {s: rows for s, rows in sets.items() if any(r[5] for r in rows)}
    index = spark.createDataFrame([r for rows in sets.values() for r in rows], INDEX).repartition(7)
    plan = planning.plan_blocks(index, factor, **SECONDS)
    got, all_blocks = {}, {}
    for r in plan.collect():
        own = got.setdefault(r.station, {})
        b = (r.segment, r.block, r.start, r.first, r["take"], r.lead, r.phase)
        if r.block is not None:
            all_blocks.setdefault(r.station, set()).add(b)
        if r.path is not None:
            own[r.path, r.offset] = None if r.block is None else own.get((r.path, r.offset), set()) | {(*b, r.place)}
    late = pieces = 0
    for s, rows in sets.items():
        want, blocks = one_by_one(rows, factor)
        assert got[s] == want, s
        assert all_blocks[s] == {(b.segment, b.number, b.start, b.offset, b.take, b.lead, b.phase) for b in blocks}
        late += sum(v is None for v in want.values())
        pieces += len({b.segment for b in blocks})
    assert late > 200 and pieces > 1000
    tasks = plan.groupBy("station").agg(F.countDistinct("piece").alias("n")).agg(F.max("n")).first()[0]
    assert tasks > 5  # a station's plan is no single task


def chunk_rows(rng, station):
    rows, t = [], 1000.0
    for block in range(rng.randint(1, 60)):
        length = rng.choice([0, 1, 7, 20, 60])
        rows.append((station, block // 20, block, t, 4.0, length))
        t += length / 4 + rng.choice([0, 0, 0, 1 / 64, 1 / 16, -1 / 32, 1 / 8, 0.375, 5.0])
    return rows


def brute_clock(rows, tolerance, inclusive):
    out, offset, anchor = [], 0, None
    for _, _, block, start, fs, n in rows:
        if not n:
            continue
        off = anchor and abs(start - (anchor[1] + (offset - anchor[0]) / fs))
        begins = anchor is None or off > tolerance / fs or (inclusive and off == tolerance / fs)
        anchor = (offset, start) if begins else anchor
        out.append((block, offset, begins, *anchor))
        offset += n
    return out


@pytest.mark.parametrize(("tolerance", "inclusive"), [(0.5, True), (1.5, False)])
def test_clocks_of_drifting_chunks(spark, tolerance, inclusive, monkeypatch):
    monkeypatch.setattr(planning, "CHUNKS", 8)
    rng = random.Random(7)
    sets = {f"s{k}": chunk_rows(rng, f"s{k}") for k in range(150)}
    chunks = spark.createDataFrame([r for rows in sets.values() for r in rows], "station string, segment int, block int, start_epoch double, fs double, len bigint").repartition(5)
    got = {}
    for r in planning.clocked(chunks, tolerance, inclusive).collect():
        got.setdefault(r.station, []).append((r.block, r.sample_offset, r.begins, r.anchor_offset, r.anchor_start))
    by_neighbours = 0
    for s, rows in sets.items():
        want = brute_clock(rows, tolerance, inclusive)
        assert sorted(got.get(s, [])) == want
        some = [r for r in rows if r[5]]
        breaks = sum(abs(b[3] - a[3] - a[5] / 4) >= tolerance / 4 for a, b in zip(some, some[1:], strict=False))
        by_neighbours += breaks + 1 != sum(w[2] for w in want) and bool(some)
    assert by_neighbours > 10  # a rule on neighbours would give other segments


def test_a_task_walks_its_stretches_one_after_the_other(spark):
    """No group of its own for each of many short stretches, and a stretch may go on in the next Arrow batch."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rng = random.Random(11)
        sets = {f"s{k}": chunk_rows(rng, f"s{k}") for k in range(20)}
        chunks = spark.createDataFrame([r for rows in sets.values() for r in rows], "station string, segment int, block int, start_epoch double, fs double, len bigint").repartition(3)
        found = planning.clocked(chunks, 0.5, True)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "FlatMapGroupsInPandas" not in plan
        got = sorted((r.station, r.block, r.sample_offset, r.begins, r.anchor_offset, r.anchor_start) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == sorted((s, *w) for s, rows in sets.items() for w in brute_clock(rows, 0.5, True))


def test_stretches_stay_whole_where_a_join_turns_to_a_broadcast(spark):
    """On larger tables the facts of stretches look too large to broadcast and prove small: then the shuffle of the join is read as its writers left it."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "40k", "spark.sql.files.maxPartitionBytes": "16k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    sets = {f"s{k}": [] for k in range(16)}
    starts = dict.fromkeys(sets, 1000.0)
    for block in range(10_000):
        s, n = f"s{block * 7 % 16}", 40 + block % 30
        sets[s].append((s, 0, block, starts[s], 4.0, n))
        starts[s] += n / 4 + {0: 0.0625, 3: -0.03125, 5: 0.125, 7: 0.375, 8: 0 if block % 5 else 100.0}.get(block % 13, 0)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        chunks = spark.createDataFrame([r for rows in sets.values() for r in rows], "station string, segment int, block int, start_epoch double, fs double, len bigint").repartition(6)
        found = planning.clocked(chunks, 1.5, False).where("begins")
        got = sorted((r.station, r.block, r.sample_offset, r.begins, r.anchor_offset, r.anchor_start) for r in found.collect())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == sorted((s, *w) for s, rows in sets.items() for w in brute_clock(rows, 1.5, False) if w[2])


def test_runs_and_window_numbers(spark):
    rows = [("a", 0, 0, 0.0, 1.0, 10), ("a", 0, 1, 10.0, 1.0, 10), ("a", 1, 2, 100.0, 1.0, 3), ("a", 1, 3, 200.0, 1.0, 8), ("b", 0, 0, 5.0, 1.0, 9)]
    places, runs = planning.runs_of(spark.createDataFrame(rows, "station string, segment int, block int, start_epoch double, fs double, len bigint"), 6, 2)
    assert sorted((r.station, r.block, r.run, r.pos, r.epoch) for r in places.collect()) == [("a", 0, 0, 0, 0.0), ("a", 1, 0, 10, 0.0), ("a", 2, 20, 0, 100.0), ("a", 3, 23, 0, 200.0), ("b", 0, 0, 0, 5.0)]
    assert sorted(map(tuple, runs.select("station", "run", "windows", "windows_before").collect())) == [("a", 0, 8, 0), ("a", 20, 0, 8), ("a", 23, 2, 8), ("b", 0, 2, 0)]


def test_scans(spark):
    rng = random.Random(3)
    data = {(k, b, o): rng.choice([None, *range(-9, 10)]) for k in "xyz" for b in range(6) for o in range(rng.randint(0, 5))}
    rows = spark.createDataFrame([(*key, v) for key, v in data.items()], "k string, b int, o int, v int")
    found = running(rows, ["k"], "b", ["o"], total=("sum", F.col("v")), most=("max", F.col("v")), n=("sum", F.lit(1)))
    for r in found.collect():
        before = [v for (k, b, o), v in data.items() if k == r.k and (b, o) < (r.b, r.o)]
        some = [v for v in before if v is not None]
        assert (r.total, r.most, r.n) == (sum(some) if some else None, max(some, default=None), len(before) or None)
    last = running(rows.where("v is not null"), ["k"], "b", ["o"], old=("last", F.col("v"))).collect()
    numbers = {(r.k, r.b, r.o): r.i for r in numbered(rows, ["k"], "b", ["o"], "i").collect()}
    for k in "xyz":
        own = sorted(key for key in data if key[0] == k)
        assert [numbers[key] for key in own] == list(range(len(own)))
        known = [key for key in own if data[key] is not None]
        assert {(r.b, r.o): r.old for r in last if r.k == k} == {key[1:]: data[known[i - 1]] if i else None for i, key in enumerate(known)}


def test_differences_cross_stretches(spark):
    rows = spark.createDataFrame([("a", k, float(k * k) if k % 7 else None) for k in range(50)] + [("b", 0, 3.0)], "s string, g bigint, v double")
    got = {(r.s, r.g): r.v_d for r in differences(rows, ["s"], "g", ["v"], "_d", span=8).collect()}
    value = lambda k: float(k * k) if k % 7 else None
    assert got == {("b", 0): None} | {("a", k): value(k) - value(k - 1) if k and value(k) is not None and value(k - 1) is not None else None for k in range(50)}
