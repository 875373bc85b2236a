"""Command line: ``python -m aridspan.cli``; catalogue, downloads, verification, index runs over files, and regions."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from aridspan import config, sinks
from aridspan.operators import catalog, inventory
from aridspan.plans import dispatcher
from aridspan.session import session
from aridspan.sources import crawl, shapefile, work
from aridspan.sources.grid_files import found_files

#: Where the public catalogue and its subset service are (fixed values).
CATALOG = "https://ds.nccs.nasa.gov/thredds/catalog/AMES/NEX/GDDP-CMIP6/"
SUBSETS = "https://ds.nccs.nasa.gov/thredds/ncss/grid/AMES/NEX/GDDP-CMIP6"


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="aridspan", description="Daily gridded climate data on Spark")
    sub = top.add_subparsers(dest="command", required=True)
    for name, arguments in (("models", ()), ("info", ("model",)), ("runs", ("model", "experiment")), ("vars", ("model", "experiment", "run")), ("report", ())):
        p = sub.add_parser(name)
        p.add_argument("--catalog", required=True, help="Parquet table: model, experiment, run, variables (see crawl)")
        for a in arguments:
            p.add_argument(a)
    p = sub.add_parser("crawl", help="reads the remote catalogue into a table")
    p.add_argument("--base", default=CATALOG)
    p.add_argument("--models", nargs="*", help="only these")
    p.add_argument("--out", required=True)
    p = sub.add_parser("files", help="the file names of a model, experiment, run and variable")
    p.add_argument("--base", default=CATALOG)
    for a in ("model", "experiment", "run", "variable"):
        p.add_argument(a)
    p = sub.add_parser("download", help="fetches the files that a configuration asks for and that are not there")
    p.add_argument("--config", required=True)
    p.add_argument("--data", required=True, help="a folder that all machines mount")
    p.add_argument("--base", default=SUBSETS)
    for a in ("model", "experiment", "variable"):
        p.add_argument(f"--{a}", help="only this one")
    p.add_argument("--years", type=int, nargs=2, help="only from, to")
    p = sub.add_parser("verify", help="found against expected files")
    p.add_argument("--config", required=True)
    p.add_argument("--data", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("run", help="the configured indices")
    p.add_argument("--config", required=True)
    of = p.add_mutually_exclusive_group(required=True)
    of.add_argument("--grid", help="Parquet table of the daily grid, in mm a day")
    of.add_argument("--data", help="folder of NetCDF files")
    p.add_argument("--out", required=True)
    p = sub.add_parser("regions", help="an index by the polygons of a shapefile")
    p.add_argument("--config", required=True)
    p.add_argument("--data", required=True)
    p.add_argument("--shapes", required=True)
    p.add_argument("--name", default="Veg_Biome", help="the column that names the polygons")
    p.add_argument("--index", default="cdd")
    p.add_argument("--experiment", default="historical")
    p.add_argument("--out", required=True)
    return top


def main(arguments: list[str] | None = None) -> list[str]:
    """Carries out a command and returns the lines it prints."""
    args = parser().parse_args(arguments)
    spark = session()
    lines: list[str] = []
    if args.command == "verify":
        cfg = config.DownloadConfig.of(config.read_yaml(args.config))
        expected = inventory.expected_files(spark, cfg, strict=True)
        checked = inventory.verify(expected, found_files(spark, args.data, cfg.experiments)).cache()
        counts = {e: b - a + 1 for e, (a, b) in cfg.time_ranges.items() if e in cfg.experiments}
        detail = inventory.in_config_order(inventory.detail_report(checked, counts), cfg)
        sinks.write_report(detail, f"{args.out}/details")
        sinks.write_report(inventory.scenario_matrix(checked, cfg.experiments), f"{args.out}/by_scenario")
        total = inventory.overall(checked).first()
        lines += [*sinks.text_table(detail).split("\n"), f"Found: {total.found}", f"Expected: {total.expected}", f"Complete: {total.completion}"]
    elif args.command == "download":
        cfg = config.DownloadConfig.of(config.read_yaml(args.config)).only(args.model, args.experiment, args.variable, args.years)
        expected = inventory.expected_files(spark, cfg)
        plan = inventory.plan_downloads(expected, found_files(spark, args.data, cfg.experiments), cfg, args.base)
        for r in crawl.download(plan, args.data, work.WorkTable(spark, f"{args.data}/_work")).orderBy("model", "experiment", "variable", "year").collect():
            lines.append(f"{r.model} {r.experiment} {r.variable} {r.year}: {r.file or r.error}")
        lines.append(f"All downloads completed: {expected.count() - len(lines)} were there")
    elif args.command == "run" and args.data:
        lines += dispatcher.run_files(spark, args.data, config.IndexConfig.of(config.read_yaml(args.config)), args.out)
    elif args.command == "run":
        done = dispatcher.run_indices(spark.read.parquet(args.grid), config.IndexConfig.of(config.read_yaml(args.config)))
        lines += done.carry_out(lambda name, table: sinks.write_ensemble(table, f"{args.out}/{name}")).report()
    elif args.command == "regions":
        shapes = shapefile.read_regions(spark, args.shapes, args.name)
        cfg = config.IndexConfig.of(config.read_yaml(args.config))
        shown = dispatcher.run_regions(spark, args.data, shapes, cfg, args.out, args.index, args.experiment)
        lines += sinks.text_table(shown).split("\n")
    elif args.command == "crawl":
        table = crawl.crawl(spark, args.base, args.out, args.models)
        lines.append(f"{table.count()} runs")
    elif args.command == "files":
        lines += crawl.files(spark, args.base, args.model, args.experiment, args.run, args.variable) or ["No files found"]
    else:
        table = spark.read.parquet(args.catalog)
        if args.command == "models":
            lines += [r.model for r in catalog.models(table).collect()]
        elif args.command == "info":
            found = catalog.info(table, args.model).orderBy("experiment", "run").collect()
            for experiment in dict.fromkeys(r.experiment for r in found):
                lines += [f"{experiment}:", *(f"  {r.run}: {r.variables}" for r in found if r.experiment == experiment)]
        elif args.command == "runs":
            lines += [r.run for r in catalog.runs(table, args.model, args.experiment).collect()]
        elif args.command == "vars":
            names = [r.variable for r in catalog.variables(table, args.model, args.experiment, args.run).collect()]
            lines.append(", ".join(names) or "No variables found")
        else:
            lines += sinks.markdown(catalog.report(table.withColumn("variables", F.array_sort("variables")))).split("\n")
    print("\n".join(lines))
    return lines


if __name__ == "__main__":
    main()
