"""Run the pipeline: ``spark-submit quartergrid/__main__.py`` or ``python -m quartergrid``."""

from __future__ import annotations

import argparse

from quartergrid.plans.pipeline import Inputs, Settings, city_models, run
from quartergrid.session import build_session
from quartergrid.sources.tables import load


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    for name in ("traffic", "weather", "daylight", "poi", "word-vectors", "out"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--city", help="fit a model of this city only")
    args = parser.parse_args()
    spark = build_session()
    inputs = Inputs(args.traffic, args.weather, args.daylight, args.poi, args.word_vectors)
    paths = run(spark, inputs, args.out)
    cities = tuple(c for c in Settings().cities if args.city in (None, c.name))
    city_models(load(spark, paths["examples"]), cities).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
