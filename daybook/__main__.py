"""The jobs on the command line.

    spark-submit --py-files daybook.zip daybook/__main__.py validate --root s3a://bucket
    python -m daybook transform --root /data/shop
"""

import argparse
import sys

from daybook.plans.arrivals_run import run_arrivals
from daybook.plans.flat_run import run_flat
from daybook.plans.gate_run import run_gate
from daybook.plans.kpi_run import run_kpis
from daybook.plans.workspace import Workspace
from daybook.session import get_session
from daybook.sources.csv_batches import read_csv
from daybook.sources.files import latest_delivery
from daybook.streaming.arrivals_stream import stream_start_events
from daybook.streaming.kpi_stream import stream_kpis


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="daybook", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    on_root = argparse.ArgumentParser(add_help=False)
    on_root.add_argument("--root", required=True, help="folder of the workspace")

    gate = jobs.add_parser("validate", parents=[on_root], help="judge the files that landed")
    gate.add_argument("--no-archive", action="store_true", help="keep no copy of the raw lines")
    for name, text in (
        ("transform", "write the KPIs of new valid files"),
        ("stream", "the same, following the gate log from a checkpoint"),
    ):
        job = jobs.add_parser(name, parents=[on_root], help=text)
        job.add_argument("--latest-only", action="store_true", help="one file per type and run")
        job.add_argument(
            "--new-files-only",
            action="store_true",
            help="KPIs of the new files alone, not of all valid rows of the touched days",
        )
    jobs.choices["stream"].add_argument("--checkpoint", required=True)
    flat = jobs.add_parser("flat", parents=[on_root], help="process flat order files")
    flat.add_argument("--categories", nargs="*", help="allowed names; default: the product file")

    for name in ("arrivals", "arrivals-stream"):
        job = jobs.add_parser(name, help="notifications to pipeline-start events")
        job.add_argument("--notifications", required=True)
        job.add_argument("--events", required=True)
        job.add_argument("--bucket", required=True)
    jobs.choices["arrivals-stream"].add_argument("--checkpoint", required=True)
    return parser


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = get_session(f"daybook {args.job}")
    if args.job == "arrivals":
        run_arrivals(spark, args.notifications, args.events, args.bucket).show()
        return 0
    if args.job == "arrivals-stream":
        stream_start_events(
            spark, args.notifications, args.events, args.checkpoint, args.bucket
        ).awaitTermination()
        return 0

    workspace = Workspace(args.root)
    if args.job == "validate":
        verdicts = run_gate(spark, workspace, archive=not args.no_archive)
        verdicts.groupBy("file_type", "verdict").count().show()
    elif args.job == "flat":
        categories = args.categories or read_csv(spark, latest_delivery(spark, workspace.products))
        run_flat(spark, workspace, categories).groupBy("verdict").count().show()
    elif args.job == "transform":
        run = run_kpis(
            spark, workspace, latest_only=args.latest_only, recompute=not args.new_files_only
        )
        if run is None:
            print("no new validated files to process")
        else:
            run.summary().show()
    else:
        stream_kpis(
            spark,
            workspace,
            args.checkpoint,
            recompute=not args.new_files_only,
            latest_only=args.latest_only,
        ).awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
