"""``python -m tremor.cli``: run, preprocess, init."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from tremor import ship, sinks
from tremor.config import Config
from tremor.plans import pipeline


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("tremor")
    p.add_argument("--config")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("run", "preprocess"):
        c = sub.add_parser(name)
        c.add_argument("--data-dir", required=True)
        c.add_argument("--out-dir", required=True)
        c.add_argument("--dry-run", action="store_true")
        for option in ("fs", "freqmin", "freqmax"):
            c.add_argument(f"--{option}", type=float)
        if name == "preprocess":
            c.add_argument("--single-file", action="store_true", help="also join the parts of the waveform to one file")
        if name == "run":
            c.add_argument("--station")
            c.add_argument("--win-sec", type=float)
    sub.add_parser("init").add_argument("--out", required=True)
    return p


def main(argv: list[str] | None = None) -> int:
    """0 if all went well, 2 for a configuration that must not run; errors of a run are raised."""
    args = _parser().parse_args(argv)
    if args.command == "init":
        with open(args.out, "w") as f:
            f.write(Config().to_json())
        return 0
    cfg = Config.load(args.config).override(**{k: getattr(args, k, None) for k in ("fs", "freqmin", "freqmax", "station", "win_sec")})
    if problems := cfg.problems():
        print("\n".join(problems), file=sys.stderr)
        return 2
    if args.dry_run:
        return 0
    spark = ship(SparkSession.builder.appName("tremor").getOrCreate())
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", f"{args.out_dir.rstrip('/')}/_work")
    stem = os.path.basename(os.path.normpath(args.data_dir))
    if args.command == "run":
        table, archive, windows = pipeline.extract(spark, args.data_dir, cfg)
        if windows:
            sinks.write_features(table, args.out_dir, stem, cfg, archive.fs)
    else:
        archive = pipeline.archive(spark, args.data_dir, cfg)
        out = f"{args.out_dir}/{stem}_preprocessed.f32"
        sinks.write_waveform(archive.blocks, archive.chunks, f"{out}.parts" if args.single_file else out, cfg, f"{out}.json")
        if args.single_file:
            sinks.join_parts(spark, f"{out}.parts", out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
