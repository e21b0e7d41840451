"""Command line: the whole pipeline, one layer, or one table of it.

    python -m strata run      --config lake.json --store hdfs:///lake [--as-of 2026-01-31] [--batch-id ID] [--incremental]
    python -m strata extract  --config lake.json --store hdfs:///lake [TABLE ...] [--batch-id ID]
    python -m strata silver   --store hdfs:///lake [TABLE ...] [--config lake.json] [--as-of ...]
    python -m strata gold     --store hdfs:///lake [MART ...] [--as-of ...]
    python -m strata gate     --store hdfs:///lake [--config lake.json]
    python -m strata validate --store hdfs:///lake [MART ...]
    python -m strata compact  --store hdfs:///lake [TABLE ...]
    python -m strata sql      --store hdfs:///lake "SELECT ... FROM silver_orders"

The config file names the sources (``strata.plans.sources_config``) and may
hold the pipeline's settings:

    {"pipeline": {"thresholds": {"orders": 2.0}, "tie_breakers": {"orders": ["order_ts"]}}, ...}
"""
from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from strata.plans.bronze import extract
from strata.plans.checks import GATE_THRESHOLDS_PCT
from strata.plans.gate import GateFailed, dq_gate
from strata.plans.gold import MARTS
from strata.plans.pipeline import SILVER_LAYOUT, PipelineConfig, run_gold, run_pipeline, run_silver
from strata.plans.sources_config import retail_sources
from strata.plans.validate import ValidationFailed, validate_outputs
from strata.session import get_session
from strata.sources.store import TableStore


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strata")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("run", "extract", "silver", "gold", "gate", "validate", "compact", "sql"):
        c = sub.add_parser(name)
        c.add_argument("--store", required=True)
        c.add_argument("--config", required=name in ("run", "extract"))
        c.add_argument("--as-of", type=dt.date.fromisoformat)
        c.add_argument("--run-ts", type=dt.datetime.fromisoformat)
        if name in ("run", "extract"):
            c.add_argument("--batch-id")
        if name == "run":
            c.add_argument("--incremental", action="store_true", help="rewrite the silver months that changed, merge the marts")
        if name == "sql":
            c.add_argument("names", nargs=1, metavar="statement")
        elif name not in ("run", "gate"):
            c.add_argument("names", nargs="*")
    return p


def _known(names: list[str], all_: list[str]) -> list[str]:
    unknown = sorted(set(names) - set(all_))
    if unknown:
        raise SystemExit(f"unknown: {', '.join(unknown)}; there are {', '.join(all_)}")
    return names or all_


def settings(args: argparse.Namespace, config: dict) -> PipelineConfig:
    own = config.get("pipeline", {})
    return PipelineConfig(
        as_of=args.as_of,
        run_ts=args.run_ts,
        thresholds={**GATE_THRESHOLDS_PCT, **own.get("thresholds", {})},
        tie_breakers=own.get("tie_breakers", {}),
        incremental=getattr(args, "incremental", False) or own.get("incremental", False),
    )


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    config = {}
    if args.config:
        with open(args.config) as fh:
            config = json.load(fh)
    cfg = settings(args, config)
    spark = get_session("strata-" + args.cmd)
    store = TableStore(spark, args.store)
    out: object = None
    try:
        if args.cmd == "run":
            result = run_pipeline(spark, store, retail_sources(config), cfg, batch_id=args.batch_id)
            out = {"silver": result.silver, "gate": result.gate}
        elif args.cmd == "extract":
            store.ensure_layers()
            specs = {s.table: s for s in retail_sources(config)}
            out = [
                vars(extract(spark, store, specs[n], run_ts=args.run_ts, batch_id=args.batch_id))
                for n in _known(args.names, list(specs))
            ]
        elif args.cmd == "silver":
            out = run_silver(store, cfg, _known(args.names, list(SILVER_LAYOUT)))
        elif args.cmd == "gold":
            run_gold(store, cfg, out := _known(args.names, MARTS))
        elif args.cmd == "gate":
            out = dq_gate(store, cfg.thresholds)
        elif args.cmd == "validate":
            out = validate_outputs(store, _known(args.names, MARTS))
        elif args.cmd == "compact":
            bronze = [t for layer, t in store.tables() if layer == "bronze"]
            out = {t: store.compact("bronze", t) for t in _known(args.names, bronze)}
        else:
            store.create_views()
            spark.sql(args.names[0]).show(truncate=False)
        if out is not None:
            print(json.dumps(out, default=str))
    except (GateFailed, ValidationFailed) as e:
        print(str(e), file=sys.stderr)
        return 2
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
