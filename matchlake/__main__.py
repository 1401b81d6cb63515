"""Run the flow from a command line: ``spark-submit`` or ``python -m matchlake``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from matchlake.plans.flow import Lake, run
from matchlake.schemas import ENTITIES


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="matchlake", description=run.__doc__)
    parser.add_argument("--root", required=True, help="folder of the layers")
    parser.add_argument("--landing", required=True, help="folder of the landed documents")
    parser.add_argument("--as-of", required=True, help="the day before this one is processed")
    parser.add_argument("--since", help="process all days from this one on")
    parser.add_argument("--entities", nargs="+", default=["fixtures"], choices=list(ENTITIES))
    parser.add_argument("--source", default="feed", help="folder name below each layer")
    parser.add_argument("--layout", default="document", choices=["document", "lines"])
    parser.add_argument("--merge-mode", default="insert", choices=["insert", "upsert"])
    parser.add_argument("--gold-new-days", action="store_true", help="offer Gold the days handed over (the default)")
    parser.add_argument("--repair", action="store_true", help="offer Gold all of Silver")
    parser.add_argument("--no-export", action="store_true")
    return parser.parse_args(arguments)


def main(arguments: Sequence[str] | None = None) -> None:
    args = parse(arguments)
    lake = Lake(
        root=args.root,
        landing=args.landing,
        source=args.source,
        layout=args.layout,
        merge_mode=args.merge_mode,
        gold_rereads_all=args.repair and not args.gold_new_days,
        export=not args.no_export,
    )
    spark = SparkSession.builder.appName("matchlake").getOrCreate()
    run(spark, lake, args.as_of, entities=args.entities, since=args.since)


if __name__ == "__main__":
    main()
