"""python -m quillgrid COMMAND: deliver a table from page images, rebuild or repair it, search it, or report on it."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import functions as F

from .operators import imaging
from .plans import flows, policy, schema
from .plans.profiles import PROFILES, profile
from .session import session, ship
from .sources import files


def named(what: str):
    """The object that ``module:name`` says: a function that builds a model."""
    module, _, name = what.partition(":")
    return getattr(importlib.import_module(module), name)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="quillgrid", description=__doc__)
    p.add_argument("command", choices=("run", "cells", "rebuild", "policy", "derive", "search", "report"))
    p.add_argument("table", help="CSV file or folder of a delivered table; for run and cells, a folder of images")
    p.add_argument("--out", help="folder for the result; policy: beside the table if not given")
    p.add_argument("--in-place", action="store_true", help="policy: over the table")
    p.add_argument("--profile", default=sorted(PROFILES)[-1], choices=sorted(PROFILES))
    p.add_argument("--reader", help="module:function that builds the reader of a cell, for run and cells")
    p.add_argument("--heading", help="module:function that builds the reader of a heading, for run")
    p.add_argument("--route", help="route of a printed text, for cells; the profile's if not given")
    p.add_argument("--json", action="store_true", help="cells: JSON lines, too")
    p.add_argument("--no-mass-gate", action="store_true", help="accept repairs whose mass has not been checked")
    p.add_argument("--states", type=int, default=500_000, help="budget of the search for each row")
    p.add_argument("--master", default="local[*]")
    a = p.parse_args(argv)
    if a.command not in ("report", "policy") and not a.out:
        p.error("--out is needed")
    if a.command in ("run", "cells") and not a.reader:
        p.error("--reader is needed")
    spark = session(a.master)
    ship(spark)
    chosen = profile(a.profile)
    if a.command == "run":
        rows, failed = flows.full_run(spark, a.table, chosen, named(a.reader), named(a.heading) if a.heading else None, require_mass_gate=not a.no_mass_gate)
        print(files.write_csv(rows, files.writable_target(a.out), rows.columns, mark=True), "rows")
        failed.show(60, truncate=False)
        return
    if a.command == "cells":
        texts = imaging.read_cells(files.images(spark, a.table, ("*.png",)), named(a.reader))
        print(files.write_cells(texts, a.out, a.route or chosen.setting("route"), a.json), "cells")
        return
    if a.command == "rebuild":
        flows.rebuild(spark, a.table, a.out, chosen)
        return
    rows = files.read_csv(spark, a.table, keep_blank=False)
    if a.command == "report":
        for name, df in flows.summary(rows.fillna("")).items():
            print(f"== {name}")
            df.show(60, truncate=False)
        return
    work = {"policy": lambda d: policy.promote(d, not a.no_mass_gate), "derive": policy.derived_layers, "search": lambda d: policy.search_layer(d, a.states)}[a.command]
    columns = schema.combined_columns(chosen.extras)
    out = a.out or files.policy_target(a.table, a.in_place)
    done = work(rows.select([F.col(c) for c in rows.columns]))
    files.write_csv(files.kept(done) if out == a.table else done, out, columns)


if __name__ == "__main__":
    main()
