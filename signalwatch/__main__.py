"""``python -m signalwatch SOURCE TARGET [--standalone]``: one run over a folder of files."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from functools import partial

from pyspark.sql import SparkSession

from signalwatch import constants as C
from signalwatch.plans import models, retail_run
from signalwatch.plans.ensembles import BoostedTrees, forest_standalone
from signalwatch.session import session, shuffle_parts
from signalwatch.sources.staging import SOURCE_FILES
from signalwatch.storage import scratch, size_of


def _options(arguments: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="signalwatch")
    parser.add_argument("source", help="folder with the source files")
    parser.add_argument("target", help="shared folder for the tables of this run")
    parser.add_argument("--file", action="append", default=[], metavar="TABLE=NAME",
                        help="file name of a source table, e.g. orders=my_orders.csv")
    parser.add_argument("--quarantine", action="store_true",
                        help="set bad rows aside instead of failing")
    parser.add_argument("--multiline", action="store_true",
                        help="allow line breaks in quoted CSV fields; files are not split")
    parser.add_argument("--reuse", action="store_true",
                        help="keep the star schema an earlier run built under TARGET")
    parser.add_argument("--audit", action="store_true",
                        help="log the inserts that are not logged yet, and summarise the log")
    parser.add_argument("--standalone", action="store_true",
                        help="use sales and the search file only")
    parser.add_argument("--trees", type=int, default=300, help="trees of the random forest")
    parser.add_argument("--depth", type=int, default=15, help="depth of its trees")
    parser.add_argument("--rounds", type=int, default=400, help="boosting rounds")
    parser.add_argument("--partitions", type=int,
                        help="parts a shuffle starts with; else the source's size over 128 MB")
    return parser.parse_args(arguments)


def main(arguments: Sequence[str] | None = None) -> None:
    options = _options(arguments)
    names = SOURCE_FILES | dict(pair.split("=", 1) for pair in options.file)
    spark = session(partitions=options.partitions)
    with scratch(spark):
        _run(spark, options, names)


def _run(spark: SparkSession, options: argparse.Namespace, names: dict[str, str]) -> None:
    if not options.partitions:
        parts = shuffle_parts(size_of(spark, options.source))
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        print(f"shuffles start with {parts} parts")
    if options.reuse:
        warehouse = retail_run.reload(spark, options.target)
    else:
        warehouse = retail_run.load(spark, options.source, options.target, names,
                                    strict=not options.quarantine, multiline=options.multiline)
    retail_run.loaded(warehouse).show(truncate=False)
    if options.audit:
        retail_run.audit(spark, options.target).show(truncate=False)

    forest = partial(forest_standalone, n_features=len(C.FEATURES_STANDALONE)) \
        if options.standalone else models.random_forest
    chosen = {
        "random_forest": lambda: forest(trees=options.trees, depth=options.depth),
        "boosted_trees": lambda: BoostedTrees(rounds=options.rounds),
    }
    if options.standalone:
        trends = retail_run.search_file(
            spark, f"{options.source}/{names['trends']}",
            f"{options.target}/rejected/search" if options.quarantine else None, options.multiline)
        outcome = retail_run.analyse_standalone(warehouse, trends, options.target, chosen)
    else:
        outcome = retail_run.analyse(warehouse, options.target, chosen)
    for name, report in outcome.reports.items():
        print(name)
        report.show(20, truncate=False)


if __name__ == "__main__":
    main()
