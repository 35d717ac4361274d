"""spark-submit entry point for the z-score job.

    spark-submit -m anthro.cli --measurement db.measurement_anthro \\
        --person db.person --grid db.bmi_child --out s3://bucket/bmiz [--site S]

Sources are catalog tables by default (``--format parquet`` etc. for
paths), with ``--measurement-format``/``--measurement-option`` and the same
for the person to set one input apart; CSV and JSON inputs get the job's
declared types.  The grid is one table ``(gender, age, l, m, s)`` or two per-sex
tables ``(age, l, m, s)`` via ``--grid-female`` / ``--grid-male``.  The
output is written partitioned by ``site_id`` to ``--out`` (path) or
``--write-table``.  ``--compile`` prints the physical plan and writes
nothing.  Environment variables are not read; pass everything explicitly.
"""

from __future__ import annotations

import argparse
import sys

from anthro.constants import (BMI_CONCEPT_ID, DAYS_PER_MONTH, DEFAULT_LABEL_PREFIX,
                              DEFAULT_VERSION, REJOIN_KEYS, ZSCORE_CONCEPT_ID)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="anthro", description="BMI-for-age z-scores on Spark")
    p.add_argument("--measurement", required=True, help="measurement table or path")
    p.add_argument("--person", required=True, help="person table or path")
    p.add_argument("--grid", help="grid table/path with gender, age, l, m, s")
    p.add_argument("--grid-female", help="female grid table/path (age, l, m, s)")
    p.add_argument("--grid-male", help="male grid table/path (age, l, m, s)")
    p.add_argument("--format", default="table",
                   help="table | parquet | orc | csv | jdbc (for the three inputs)")
    p.add_argument("--option", action="append", default=[], metavar="K=V",
                   help="reader option, e.g. url=jdbc:... (repeatable)")
    for name in ("measurement", "person"):
        p.add_argument(f"--{name}-format", help=f"format of the {name} input if it differs")
        p.add_argument(f"--{name}-option", action="append", default=[], metavar="K=V",
                       help=f"reader option for the {name} input alone (repeatable)")
    p.add_argument("--person-one-task", action="store_true",
                   help="allow an unpartitioned JDBC read of the person table")
    p.add_argument("--rebalance", action="store_true",
                   help="shuffle the output by site into few, well-sized files")
    p.add_argument("--grid-format", help="format of the grid input(s) if it differs, e.g. csv")
    p.add_argument("--grid-option", action="append", default=[], metavar="K=V",
                   help="reader option for the grid, e.g. header=true (repeatable)")
    p.add_argument("--out", help="output path")
    p.add_argument("--write-table", help="output catalog table")
    p.add_argument("--site", help="restrict to one site_id")
    p.add_argument("--measurement-concept-id", type=int, default=BMI_CONCEPT_ID)
    p.add_argument("--zscore-concept-id", type=int, default=ZSCORE_CONCEPT_ID)
    p.add_argument("--days-per-month", type=float, default=DAYS_PER_MONTH)
    p.add_argument("--version", default=DEFAULT_VERSION)
    p.add_argument("--label-prefix", default=DEFAULT_LABEL_PREFIX)
    p.add_argument("--neighbor-rank", type=int, default=1,
                   help="1 = nearest grid ages (intended); 2 = as the original job runs")
    p.add_argument("--drop-null-rejoin-keys", action="store_true",
                   help="drop rows with a NULL in any of the nine re-join keys")
    p.add_argument("--strict", action="store_true", help="strict z-score guards")
    p.add_argument("--hot-key-fraction", type=float,
                   help="split persons owning more than this share of the rows")
    p.add_argument("--hot-key-strategy", choices=["salt", "split"], default="salt",
                   help="salt (one scan) or split (inputs bucketed on person_id)")
    p.add_argument("--compile", action="store_true", help="print the plan, write nothing")
    return p


def main(argv=None) -> int:
    args = build_parser().parse_args(argv)
    if not (args.grid or (args.grid_female and args.grid_male)):
        print("give --grid or both --grid-female and --grid-male", file=sys.stderr)
        return 2
    if not args.compile and not (args.out or args.write_table):
        print("give --out or --write-table (or --compile)", file=sys.stderr)
        return 2
    from anthro.plans.zscore_job import run_zscore_job
    from anthro.session import get_session
    from anthro.sources.grids import union_sexes
    from anthro.sources.tables import MEASUREMENT_SCHEMA, PERSON_SCHEMA, read_source

    spark = get_session()
    opts = dict(o.split("=", 1) for o in args.option)

    grid_opts = dict(o.split("=", 1) for o in args.grid_option) if args.grid_option else opts

    def read(src, fmt, own, schema, one_task=False):
        return read_source(spark, src, fmt or args.format, opts | dict(o.split("=", 1) for o in own), schema, one_task)

    def read_grid(src):
        return read_source(spark, src, args.grid_format or args.format, grid_opts, one_task=True)

    measurement = read(args.measurement, args.measurement_format, args.measurement_option, MEASUREMENT_SCHEMA)
    person = read(args.person, args.person_format, args.person_option, PERSON_SCHEMA, args.person_one_task)

    grid = (read_grid(args.grid) if args.grid
            else union_sexes(read_grid(args.grid_female), read_grid(args.grid_male)))
    out = run_zscore_job(
        measurement, person, grid, args.out, table=args.write_table,
        explain_only=args.compile, rebalance=args.rebalance, measurement_concept_id=args.measurement_concept_id,
        zscore_concept_id=args.zscore_concept_id, days_per_month=args.days_per_month,
        version=args.version, label_prefix=args.label_prefix, neighbor_rank=args.neighbor_rank,
        drop_null_keys=REJOIN_KEYS if args.drop_null_rejoin_keys else (), strict=args.strict,
        site=args.site, hot_key_fraction=args.hot_key_fraction,
        hot_key_strategy=args.hot_key_strategy)
    if out is not None:
        print(out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
