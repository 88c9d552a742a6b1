"""``python -m veilframe``, or the main file of a ``spark-submit``."""

from __future__ import annotations

import argparse

from veilframe import jobs
from veilframe.operators.treating import INTEGERS
from veilframe.plans.linkspec import KEY_MODES
from veilframe.session import fit_shuffles, session


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="veilframe", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--format", default="csv", choices=("csv", "parquet"))

    for name in ("profile", "pseudonymize"):
        command = commands.add_parser(name, parents=[common])
        command.add_argument("table")
        command.add_argument("policy")
        command.add_argument("output")
        if name == "profile":
            command.add_argument("--parts")
        else:
            command.add_argument("--seed", type=int)
            command.add_argument("--statistics")
            command.add_argument("--integers", default="text", choices=INTEGERS)
            command.add_argument("--refused")
            command.add_argument("--identity", nargs="+", metavar="COLUMN")

    command = commands.add_parser("link", parents=[common])
    for argument in ("table_a", "table_b", "spec", "output"):
        command.add_argument(argument)
    command.add_argument("--no-header", dest="header", action="store_false")
    command.add_argument("--key-mode", default="columns", choices=KEY_MODES)
    command.add_argument("--drop-empty-keys", action="store_true")
    command.add_argument("--split-hot-keys", action="store_true")
    command.add_argument("--secret", help="a file whose bytes key the tokens")
    return top


def main(arguments: list[str] | None = None) -> None:
    options = vars(parser().parse_args(arguments))
    command = options.pop("command")
    spark = session(f"veilframe {command}")
    if command == "link":
        fit_shuffles(spark, options["table_a"], options["table_b"])
    report = getattr(jobs, f"run_{command}")(spark, **options)
    if report is not None:
        # A row per figure that the policy asks for.
        report.show(report.count(), truncate=False)


if __name__ == "__main__":
    main()
