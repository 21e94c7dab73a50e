"""``python -m crowdtape direction|moods|report ...``; master and memory come from spark-submit."""

from __future__ import annotations

import argparse

from crowdtape import plans
from crowdtape.plans.direction import FOLDS, TREES
from crowdtape.session import get_spark
from crowdtape.sources import read_lexicon

DAYS = ("start", "end")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="crowdtape", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, inputs in (
        ("direction", ("prices", "lexicon")),
        ("moods", ("labeled",)),
        ("report", ("prices", "output")),
    ):
        job = jobs.add_parser(name)
        for option in ("posts", *inputs, "work-dir"):
            job.add_argument(f"--{option}", required=True)
        job.add_argument("--start", help="first day, such as 2016-03-01")
        job.add_argument("--end", help="last day")
        if name != "report":
            job.add_argument("--cap", type=int, help="at most so many random posts a day; all by default")
            job.add_argument("--seed", type=int, default=0)
            job.add_argument("--lenient-time", action="store_true")
        if name == "direction":
            job.add_argument("--mode", choices=("calendar", "next_row"), default="calendar")
            job.add_argument("--trees", type=int, default=TREES)
            job.add_argument("--folds", type=int, default=FOLDS)
    args = parser.parse_args(argv)

    spark = get_spark(f"crowdtape {args.job}")
    if args.job == "direction":
        lexicon = read_lexicon(spark, args.lexicon)
        options = {n: getattr(args, n) for n in DAYS + ("cap", "seed", "lenient_time", "mode", "trees", "folds")}
        result = plans.direction_job(spark, args.posts, args.prices, lexicon, args.work_dir, **options)
        spark.read.parquet(f"{args.work_dir}/step_counts").show()
        print(f"mean weighted recall: {result.avgMetrics[0]}")
    elif args.job == "moods":
        options = {n: getattr(args, n) for n in DAYS + ("cap", "seed", "lenient_time")}
        moods = plans.mood_job(spark, args.posts, args.labeled, args.work_dir, **options)
        moods.groupBy("prediction").count().orderBy("prediction").show()
    else:
        options = {n: getattr(args, n) for n in DAYS}
        plans.report_job(spark, args.posts, args.prices, args.work_dir, args.output, **options)


if __name__ == "__main__":
    main()
