"""``python -m tillsight <job> <arguments>`` inside spark-submit or a local session."""

from __future__ import annotations

import argparse
import inspect

from pyspark.sql import DataFrame, SparkSession

from .functions.staging import drop_staged
from .plans import jobs

JOBS = {
    f.__name__.replace("_", "-"): f
    for f in (jobs.preprocess, jobs.build_features, jobs.train, jobs.predict, jobs.explain_forecast,
              jobs.forecast_product, jobs.segment, jobs.segment_requests)
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tillsight")
    commands = parser.add_subparsers(dest="job", required=True)
    for name, job in JOBS.items():
        sub = commands.add_parser(name, help=inspect.getdoc(job))
        for p in list(inspect.signature(job).parameters.values())[1:]:
            if p.default is inspect.Parameter.empty:
                sub.add_argument(p.name)
            else:
                kind = type(p.default) if isinstance(p.default, int) else str
                sub.add_argument(f"--{p.name.replace('_', '-')}", default=p.default, type=kind)
    options = vars(parser.parse_args(argv))
    job = JOBS[options.pop("job")]
    shared = SparkSession.getActiveSession() is not None
    spark = SparkSession.builder.appName("tillsight").getOrCreate()
    out = job(spark, **options)
    if isinstance(out, DataFrame):
        out.show(truncate=False)
    if not shared:
        drop_staged(spark)
        spark.stop()


if __name__ == "__main__":
    main()
