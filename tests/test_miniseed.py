"""Hand-made records of each encoding, through the reader and both pipelines."""

import json
import os
import struct
import subprocess
import sys

import numpy as np
import pytest

from tests.conftest import ROOT
from tremor import cli, sinks
from tremor.config import Config
from tremor.plans import pipeline
from tremor.sources import miniseed as ms


def record2(channel, start, x, encoding, fs=10, order=">", raw=None, power=9):
    """A version 2 record; ``start`` is seconds after 2024-01-01."""
    day, rest = divmod(start, 86400)
    h, m, s = int(rest // 3600), int(rest % 3600 // 60), rest % 60
    data = raw if raw is not None else np.asarray(x).astype({1: order + "i2", 3: order + "i4", 4: order + "f4", 5: order + "f8"}[encoding]).tobytes()
    head = b"000001D " + b"ELZG " + b"  " + channel.encode() + b"KO" + struct.pack(order + "HHBBBBHHhhBBBBiHH", 2024, 1 + int(day), h, m, int(s), 0, round(s % 1 * 1e4), len(x), fs, 1, 0, 0, 0, 1, 0, 64, 48)
    head += struct.pack(order + "HHBBBB", 1000, 0, encoding, order == ">", power, 0)
    return (head.ljust(64, b"\0") + data).ljust(1 << power, b"\0")


def record3(sid, start, x, fs=10.0):
    data = np.asarray(x, "<i4").tobytes()
    head = b"MS\x03\x00" + struct.pack("<IHHBBBBdII", 0, 2024, 1, 0, 0, int(start), 3, fs, len(x), 0) + struct.pack("<BBHI", 1, len(sid), 0, len(data))
    return head + sid.encode() + data


def steim(x, level):
    """One frame: bytes as differences (nibble 1) after the first sample."""
    d = [0, *np.diff(x).tolist()]
    d += [0] * (-len(d) % 4)
    words = [struct.pack(">i", x[0]), struct.pack(">i", x[-1])] + [struct.pack(">4b", *d[i : i + 4]) for i in range(0, len(d), 4)]
    assert len(words) <= 15
    control = sum(1 << (30 - 2 * (k + 3)) for k in range(len(words) - 2))
    return (struct.pack(">I", control) + b"".join(words)).ljust(64, b"\0")


X = [5, -3, 100, 7, 0, 90, 12, -20]


@pytest.mark.parametrize("encoding", [1, 3, 4, 5])
@pytest.mark.parametrize("order", [">", "<"])
def test_plain_encodings(encoding, order):
    (row,) = ms.records("f", record2("HHZ", 1.5, X, encoding, order=order), True)
    assert row[4] == "Z" and row[5] == 1704067200 + 1.5 and row[6:8] == (8, 10.0) and row[8].tolist() == X


@pytest.mark.parametrize("level", [1, 2])
def test_steim(level):
    (row,) = ms.records("f", record2("HHE", 0, X, 9 + level, raw=steim(X, level)), True)
    assert row[8].tolist() == X


def test_steim2_fields():
    kinds = [(2, 1, 30, [7]), (2, 2, 15, [-3, 9]), (2, 3, 10, [1, -2, 3]), (3, 0, 6, [5, -6, 7, 0, 1]), (3, 1, 5, [1, 2, 3, -4, 5, 6]), (3, 2, 4, [1, -1, 2, -2, 3, -3, 4])]
    control, words, d = 0, [struct.pack(">i", 50), struct.pack(">i", 0)], []
    for k, (c, sub, bits, v) in enumerate(kinds):
        control |= c << (30 - 2 * (k + 3))
        w = sub << 30
        for j, y in enumerate(v):
            w |= (y & ((1 << bits) - 1)) << (bits * (len(v) - 1 - j))
        words.append(struct.pack(">I", w))
        d += v
    frame = (struct.pack(">I", control) + b"".join(words)).ljust(64, b"\0")
    assert ms.unsteim(frame, len(d), ">", 2).tolist() == np.cumsum([50, *d[1:]]).tolist()


def test_version_3_tail_and_errors():
    data = record3("FDSN:KO_ELZG__H_H_N", 4, X) + record2("HHZ", 0, X, 3) + b"x" * 63
    a, b = ms.records("f", data, True)
    assert a[4] == "N" and a[8].tolist() == X and b[4] == "Z"
    assert list(ms.records("f", record3("NET.STA.LOC.HHZ", 4, X), True)) == []  # its last part begins with H
    with pytest.raises(ms.FormatError, match="Unsupported sample type"):
        list(ms.records("f", record2("HHZ", 0, X, 0, raw=b"text"), True))
    with pytest.raises(ms.FormatError, match="Not miniSEED"):
        list(ms.records("f", b"\1" * 100, True))


def test_components():
    assert [ms.component_of(s) for s in ("a_Z", "a.n", "a_2", "a_1x", "e", "a_H", "a.")] == ["Z", "N", "N", "E", "E", None, None]


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    """Three components of 20 minutes at 10 Hz, with a pause of three hours, out of order over two files."""
    folder = tmp_path_factory.mktemp("archive")
    rng = np.random.default_rng(1)
    parts = []
    for base in (0, 12_000):
        for c in "ENZ":
            x = (rng.normal(size=12_000).cumsum() % 1000).astype(int)
            parts += [record2(f"HH{c}", base + k / 10, x[k : k + 100], 3) for k in range(0, 12_000, 100)]
    order = rng.permutation(len(parts))
    for name, rows in (("a", order[::2]), ("b", order[1::2])):
        (folder / name).write_bytes(b"".join(parts[i] for i in rows))
    return folder


def test_data_source_filters_components(spark, archive):
    ms.register(spark)
    rows = spark.read.format("miniseed").option("columns", "header").load(str(archive))
    assert rows.count() == 720 and rows.where("component = 'E'").count() == 240


def test_run_and_preprocess(spark, archive, tmp_path):
    cfg = Config(fs=5.0, win_sec=60, step_sec=30, lta_sec=20)
    table, found, windows = pipeline.extract(spark, str(archive), cfg)
    rows = table.orderBy("Zaman_Dk").collect()
    assert len(table.columns) == 105 and len(rows) == windows == 2 * ((6000 - 300) // 150 + 1) and (found.native, found.fs, found.late) == (10.0, 5.0, 0)
    assert rows[0].Pencere_ID == "ELZG_w01" and rows[0].Zaman_Dk == pytest.approx((1704067200 + 60) / 60) and rows[0].E_RMS_DEV is None
    assert [r.Pencere_ID for r in rows] == [f"ELZG_w{k + 1:02}" for k in range(windows)]
    for a, b in zip(rows, rows[1:], strict=False):  # also across the pause
        assert b.E_RMS_DEV == pytest.approx(b.E_RMS - a.E_RMS) and b.NZ_CROSS_CORR_DEV == pytest.approx(b.NZ_CROSS_CORR - a.NZ_CROSS_CORR)
    side = sinks.write_waveform(found.blocks, found.chunks, str(tmp_path / "out.f32"), cfg)
    assert json.loads((tmp_path / "out.f32.json").read_text()) == side
    names = sorted(p.name for p in (tmp_path / "out.f32").iterdir())
    assert all(n.startswith("part-") for n in names)  # nothing of the writing is left
    wave = np.concatenate([np.fromfile(tmp_path / "out.f32" / n, "<f4") for n in names]).reshape(-1, 3)
    assert len(wave) == side["samples"] == 12_000 and [s["sample_offset"] for s in side["segments"]] == [0, 6000]
    blocks = found.blocks.orderBy("segment", "block").collect()
    assert np.array_equal(wave, np.concatenate([np.stack([b.e, b.n, b.z], axis=1) for b in blocks]).astype("f4"), equal_nan=True)
    sinks.write_waveform(found.blocks, found.chunks, str(tmp_path / "out.f32"), cfg)
    sinks.join_parts(spark, str(tmp_path / "out.f32"), str(tmp_path / "one"))
    assert np.array_equal(np.fromfile(tmp_path / "one", "<f4").reshape(-1, 3), wave)
    path = sinks.write_features(table, str(tmp_path), "x", cfg, 5.0)
    assert spark.read.parquet(path).columns[:4] == ["Pencere_ID", "Zaman_Dk", "EN_CROSS_CORR", "EZ_CROSS_CORR"]


def waveform(spark, folder, rows):
    """Sidecar, and samples read back, of chunks (segment, block, start, e, n, z) at 4 Hz."""
    blocks = spark.createDataFrame([("s", s, b, t, 4.0, *[[float(v) for v in c] for c in x]) for s, b, t, *x in rows], pipeline.CHUNK)
    chunks = spark.createDataFrame([("s", s, b, t, 4.0, min(map(len, x))) for s, b, t, *x in rows], "station string, segment int, block int, start_epoch double, fs double, len bigint")
    side = sinks.write_waveform(blocks, chunks, str(folder), Config())
    data = [np.fromfile(p, "<f4") for p in sorted(folder.glob("part-*"))] if folder.exists() else []
    return side, np.concatenate(data).reshape(-1, 3) if data else np.zeros((0, 3))


def test_segments_follow_their_own_clock(spark, tmp_path):
    """Each chunk starts an eighth of a sample later than the one before ends: the clock breaks with the fourth after its first, not with any single step."""
    x, starts, t = np.arange(30.0), [], 500.0
    for _ in range(10):
        starts.append(t)
        t += 3 / 4 + 1 / 32
    side, wave = waveform(spark, tmp_path / "a", [(0, k, s, x[3 * k : 3 * k + 3], -x[3 * k : 3 * k + 4], x[3 * k : 3 * k + 3] / 2) for k, s in enumerate(starts)])
    assert [s["sample_offset"] for s in side["segments"]] == [0, 12, 24] and [s["start_epoch"] for s in side["segments"]] == [starts[0], starts[4], starts[8]]
    assert np.array_equal(wave, np.stack([x, -x, x / 2], axis=1).astype("f4"))  # cut to the shortest component
    nan = np.nan
    side, wave = waveform(spark, tmp_path / "b", [(0, 0, 10.0, [nan, 2, nan], [1, nan, 3], [4, 5, 6]), (1, 1, 99.0, [nan], [nan], [7])])
    assert side["nan_counts"] == {"E": 3, "N": 2, "Z": 0} and np.isnan(wave).sum(axis=0).tolist() == [3, 2, 0] and len(side["segments"]) == 2
    side, wave = waveform(spark, tmp_path / "c", [(0, 0, 10.0, [], [], [])])
    assert (side["samples"], side["fs"], side["segments"], len(wave)) == (0, 0.0, [], 0)


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    from pyspark.sql import functions as F

    waveform(spark, tmp_path / "w", [(0, 0, 0.0, [1.0, 2], [3, 4], [5, 6])])
    kept = sorted((p.name, p.read_bytes()) for p in (tmp_path / "w").iterdir())
    rows = spark.createDataFrame([(k, [1.0], [2.0], [3.0]) for k in range(8)], "sample_offset bigint, e array<double>, n array<double>, z array<double>")
    broken = rows.repartition(4).withColumn("z", F.when(F.col("sample_offset") == 5, F.raise_error(F.lit("broken"))).otherwise(F.col("z")))
    with pytest.raises(Exception, match="broken"):
        broken.write.format("f32").mode("append").save(str(tmp_path / "w"))
    assert sorted((p.name, p.read_bytes()) for p in (tmp_path / "w").iterdir()) == kept


def mixed_file(rng, n):
    """Records of both versions, several lengths, codings and byte orders one after the other, with payloads that hold digits and letters of headers."""
    out = b""
    for k in range(n):
        x = rng.integers(-40, 40, int(rng.integers(1, 12))).cumsum().tolist()
        start, kind = 10.0 * k, int(rng.integers(0, 6))
        if kind == 0:
            out += record3("FDSN:KO_ELZG__H_H_" + "ENZ"[k % 3], k % 60, x)
        elif kind in (1, 2):
            out += record2("HH" + "ENZ"[k % 3], start, x, 9 + kind, raw=steim(x, kind), power=int(rng.choice([7, 8, 9])))
        else:
            out += record2("HH" + "ENZQ"[k % 4], start, x, [3, 4, 5][kind - 3], order="<>"[k % 2], power=int(rng.choice([8, 9, 12])))
        if kind == 3:
            out = out[:-40] + b"000001D 000002D MS\x03".ljust(40, b"0")
    return out


def test_ranges_find_their_records():
    rng = np.random.default_rng(8)
    data = mixed_file(rng, 120) + b"tail" * 10
    source = lambda: ms.Bytes(lambda at, n: data[at : at + n], len(data))
    read = lambda lo, hi: [r for b in ms.batches("f", source(), lo, hi, True, ms.Wanted()) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    whole = read(0, len(data))
    assert len(whole) > 90
    for split in (64, 333, 1000, 4096, 20_000):
        assert [r for lo in range(0, len(data), split) for r in read(lo, min(lo + split, len(data)))] == whole


def test_index_reads_headers_only(spark, tmp_path):
    x = np.arange(900)
    (tmp_path / "long").write_bytes(b"".join(record2("HH" + "ENZ"[k % 3], 90.0 * k, x, 3, power=12) for k in range(300)))
    size = 300 * 4096
    taken = 0
    for lo in range(0, size, size // 4):
        source = ms.opened(str(tmp_path / "long"), size, ms.HEAD)
        assert sum(b.num_rows for b in ms.batches("f", source, lo, lo + size // 4, False, ms.Wanted())) == 75
        taken += source.taken
    assert taken < 0.05 * size + 3 * 70_000  # three of the ranges look for their first record
    rows = ms.read_records(spark, str(tmp_path), split=100_000)
    assert rows.rdd.getNumPartitions() > 1 and rows.count() == 300
    assert [len(r.samples) for r in ms.read_records(spark, str(tmp_path), samples=True, split=100_000).collect()] == [900] * 300


def test_filters_on_time_reach_the_source(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"".join(record2("HHZ", 10.0 * k, X, 3, power=12) for k in range(100)))
    ms.register(spark)
    rows = spark.read.format("miniseed").load(str(tmp_path))
    t = 1704067200.0
    some = rows.where(f"start_epoch >= {t + 200} and start_epoch < {t + 500} and component = 'Z'")
    assert sorted(r.start_epoch - t for r in some.collect()) == [10.0 * k for k in range(20, 50)]
    assert "Filter" not in some._jdf.queryExecution().optimizedPlan().toString().replace("isnotnull", "") or "start_epoch >=" not in some._jdf.queryExecution().executedPlan().toString()
    size = 100 * 4096
    reads = []
    for wanted in (ms.Wanted(), ms.Wanted(least=t + 200, below=t + 500)):
        source = ms.opened(str(tmp_path / "a"), size, ms.HEAD)
        list(ms.batches("a", source, 0, size, True, wanted))
        reads.append(source.taken)
    assert reads[1] < 0.4 * reads[0]


def test_many_records_decode_as_one_by_one():
    rng = np.random.default_rng(5)
    parts, headers, want = [], [], []
    for _ in range(300):
        x = rng.integers(-30, 30, int(rng.integers(1, 40))).cumsum().tolist()
        encoding, order = int(rng.choice([1, 3, 4, 5, 10, 11])), str(rng.choice(["<", ">"]))
        if encoding > 9:
            order = ">"
            parts.append(steim(x, encoding - 9) if rng.random() < 0.9 else b"")
        else:
            parts.append(np.asarray(x).astype(order + {1: "i2", 3: "i4", 4: "f4", 5: "f8"}[encoding]).tobytes())
        headers.append({"encoding": encoding, "order": order, "count": len(x) - int(rng.integers(0, 2))})
        want.append([float(v) for v in x[: headers[-1]["count"]]] if parts[-1] else [])
    values, n = ms.decode_many(parts, headers)
    assert [v.tolist() for v in np.split(values, np.cumsum(n)[:-1])] == want


def test_stream_equals_batch_and_drains_when_left_alone(spark, archive, tmp_path):
    """Records arrive shuffled, in several batches; the last blocks come out by a timer."""
    import time

    from pyspark.sql import functions as F

    from tremor.plans.planning import plan_blocks
    from tremor.streaming.assembler import assemble_stream, state_store

    cfg, native = Config(fs=5.0), 10.0
    seconds = {"block_s": 300.0, "slack_s": 20.0, "context_s": 30.0, "reset_s": 900.0}
    index = ms.read_records(spark, str(archive), samples=True).withColumn("station", F.lit("ELZG"))
    batch = pipeline.blocks_of(index, plan_blocks(index.drop("samples"), 2, **seconds), cfg, native).orderBy("segment", "block").collect()
    rows = index.select("station", "start_epoch", "path", "offset", "component", "samples")
    day = F.floor((F.col("start_epoch") - 1704067200 + F.pmod(F.hash("offset", "path"), F.lit(100))) / 2500)  # up to 100 s out of order over the batches
    lots = [r[0] for r in rows.select(day.alias("d")).distinct().orderBy("d").collect()]
    assert len(lots) > 2
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    with state_store(spark):
        query = assemble_stream(stream, native, cfg, delay_s=120.0, idle_s=4.0, **seconds).writeStream.format("memory").queryName("blocks").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start()
        try:
            for d in lots:
                rows.where(day == d).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            deadline = time.time() + 120
            while spark.table("blocks").count() < len(batch) and time.time() < deadline and query.isActive:
                time.sleep(1)
        finally:
            query.stop()
    assert query.exception() is None
    streamed = spark.sql("select * from blocks order by segment, block").collect()
    assert len(batch) == len(streamed) == 8
    for a, b in zip(batch, streamed, strict=True):
        assert a[:5] == b[:5] and all(np.allclose(x, y, equal_nan=True) for x, y in zip(a[5:], b[5:], strict=True))


def test_command_line(tmp_path, capsys):
    assert cli.main(["init", "--out", str(tmp_path / "c.json")]) == 0 and Config.load(str(tmp_path / "c.json")) == Config()
    assert cli.main(["--config", str(tmp_path / "c.json"), "preprocess", "--data-dir", "in", "--out-dir", "out", "--freqmin", "0.5", "--fs", "8", "--freqmax", "1.5", "--dry-run"]) == 0
    assert cli.main(["run", "--data-dir", "in", "--out-dir", "out", "--freqmin", "3", "--dry-run"]) == 2
    assert "freqmin" in capsys.readouterr().err


def test_command_line_runs(spark, archive, tmp_path):
    """Both commands as a user starts them; a folder without a whole window gives a warning and no table."""
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2 pyspark-shell"}

    def start(*args):
        return subprocess.run([sys.executable, "-m", "tremor.cli", *args, "--data-dir", str(archive), "--out-dir", str(tmp_path / "out")], cwd=ROOT, env=env, capture_output=True, text=True, timeout=300)

    done = start("run", "--win-sec", "100")
    assert done.returncode == 0, done.stderr[-2000:]
    name = archive.name
    table = spark.read.parquet(str(tmp_path / "out" / f"{name}_features.parquet"))
    assert table.count() == 2 * ((6000 - 500) // 250 + 1) and json.loads((tmp_path / "out" / f"{name}_features.run_metadata.json").read_text())["fs"] == 5.0
    done = start("preprocess", "--single-file", "--fs", "3", "--freqmax", "1.2")
    assert done.returncode == 0 and "output rate is 3.33" in done.stderr, done.stderr[-2000:]
    side = json.loads((tmp_path / "out" / f"{name}_preprocessed.f32.json").read_text())
    assert side["samples"] * 12 == (tmp_path / "out" / f"{name}_preprocessed.f32").stat().st_size and len(side["segments"]) == 2
    done = start("run", "--win-sec", "5000", "--station", "NONE")
    assert done.returncode == 0 and "no window" in done.stderr
