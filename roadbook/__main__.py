"""Run the job or one of its steps: ``python -m roadbook run --lake /data/lake``.

With spark-submit, give this file and the package as ``--py-files``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from itertools import islice

from pyspark.sql import DataFrame

from roadbook.plans import job
from roadbook.session import build_session
from roadbook.sources.lake import Lake
from roadbook.streaming.arrivals import refresh_on_arrival


PAGE = 100


def _show(title: str, table: DataFrame) -> None:
    """Print a whole answer page by page, each as wide as its own values. It is computed once, and the
    driver holds a page and a partition of it, not all.
    """
    print(f"\n=== {title}")
    rows = iter(table.toLocalIterator(prefetchPartitions=True))
    page, total = list(islice(rows, PAGE)), 0
    while True:
        _print_page(table.columns, [["NULL" if v is None else str(v) for v in row] for row in page])
        total += len(page)
        page = list(islice(rows, PAGE))
        if not page:
            break
    print(f"({total} rows)")


def _print_page(names: Sequence[str], rows: Sequence[Sequence[str]]) -> None:
    widths = [max(map(len, column)) for column in zip(names, *rows)]
    line = "+".join("-" * width for width in widths)
    print("|".join(n.ljust(w) for n, w in zip(names, widths)), line, sep="\n")
    for row in rows:
        print("|".join(v.ljust(w) for v, w in zip(row, widths)))


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="roadbook", description=__doc__)
    steps = ["run", "silver", "gold", "queries", "cost", "arrivals"]
    parser.add_argument("step", choices=steps)
    parser.add_argument("--lake", required=True, help="folder of the zones raw, staging, curated")
    parser.add_argument("--only", nargs="+", metavar="DAY", help="days to rebuild (default: all)")
    parser.add_argument("--city", help="city of the scan comparison")
    parser.add_argument("--day", help="day of the scan comparison")
    parser.add_argument("--fresh", action="store_true", help="run: rebuild what is up to date too")
    given = parser.parse_args(arguments)
    if given.step == "cost" and not (given.city and given.day):
        parser.error("cost needs --city and --day")

    spark = build_session()
    lake = Lake(given.lake.rstrip("/"))
    cost_of = (given.city, given.day) if given.city and given.day else None
    if given.step == "run":
        result = job.run(spark, lake, given.only, cost_of, given.fresh)
        _show("cleaning", result.cleaning)
        _show("gold tables", result.gold)
        for name, table in result.queries.items():
            _show(name, table)
        if result.cost:
            _show("scan costs", result.cost)
    elif given.step == "silver":
        job.build_silver(spark, lake, given.only)
        _show("cleaning", job.cleaning_report(spark, lake, given.only))
    elif given.step == "gold":
        job.build_gold(spark, lake, given.only)
        _show("gold tables", job.build_report(spark, lake))
    elif given.step == "queries":
        for name, table in job.queries(spark, lake).items():
            _show(name, table)
    elif given.step == "cost":
        _show("scan costs", job.cost_comparison(spark, lake, *cost_of))
    else:
        days = refresh_on_arrival(spark, lake, f"{lake.base}/arrivals")
        print("rebuilt:", *days or ["nothing"])
    spark.stop()


if __name__ == "__main__":
    main()
