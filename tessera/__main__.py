"""python -m tessera explore|crosscountry|quality|dedup|serve: the whole runs from a shell."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tessera.config import MAX_BLOCK, STOP_FREQ, Settings
from tessera.operators.http import serve
from tessera.operators.model import Matcher
from tessera.operators.serve import NameIndex, Service
from tessera.plans import jobs
from tessera.sources.io import read_names


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tessera")
    runs = parser.add_subparsers(dest="run", required=True)
    explore = runs.add_parser("explore")
    explore.add_argument("data")
    explore.add_argument("--out", default="work")
    explore.add_argument("--no-values", action="store_true")
    explore.add_argument("--rows", type=int)
    explore.add_argument("--gold")
    runs.add_parser("crosscountry")
    runs.add_parser("quality")
    dedup = runs.add_parser("dedup")
    dedup.add_argument("--threshold", type=float, default=0.0)
    dedup.add_argument("--sample", type=int, default=0)
    dedup.add_argument("--max-block", type=int, default=MAX_BLOCK)
    dedup.add_argument("--soundex", action="store_true")
    dedup.add_argument("--stop-freq", type=int, default=STOP_FREQ)
    web = runs.add_parser("serve")
    web.add_argument("--port", type=int, default=8000)
    chosen = parser.parse_args(args)
    settings, spark = Settings.from_env(), SparkSession.builder.getOrCreate()
    if chosen.run == "explore":
        jobs.explore(spark, chosen.data, chosen.out, chosen.gold, not chosen.no_values, chosen.rows)
    elif chosen.run == "crosscountry":
        jobs.cross_country(spark, settings)
    elif chosen.run == "quality":
        jobs.quality(spark, settings)
    elif chosen.run == "dedup":
        jobs.deduplicate(spark, settings, chosen.threshold or None, chosen.sample or None, chosen.max_block, chosen.soundex, chosen.stop_freq)
    else:
        index = NameIndex.build(read_names(spark, settings.index)) if settings.index else None
        serve(spark, Service(Matcher.load(f"{settings.work}/matcher"), index), chosen.port).serve_forever()


if __name__ == "__main__":
    main()
