"""python -m barloom --config config.json [--profile ci] [--refresh | --verify-only]"""

from __future__ import annotations

import argparse

from barloom.plans.build import build
from barloom.plans.config import load_config
from barloom.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="barloom", description="Bring a candle database up to date")
    parser.add_argument("--config", required=True)
    parser.add_argument("--profile", choices=("local", "ci"), default="local")
    mode = parser.add_mutually_exclusive_group()
    mode.add_argument("--refresh", action="store_true", help="build everything again")
    mode.add_argument("--verify-only", action="store_true", help="only check the outputs")
    args = parser.parse_args()
    config = load_config(args.config, args.profile)
    report = build(build_session("barloom", **config.spark_conf), config, args.refresh, args.verify_only)
    print(f"{report.state}: {report.rows:,} rows in {report.files:,} files; sources {report.actions}")


if __name__ == "__main__":
    main()
