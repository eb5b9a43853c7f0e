"""Command line: ``python -m colloqua extract|clean|merge|preview|stats|sources``."""

from __future__ import annotations

import argparse
import dataclasses

from colloqua.config import load_settings
from colloqua.plans import pipeline
from colloqua.session import clean_shared, local_session
from colloqua.sources.files import count_records, source_catalogue
from colloqua.sources.model_client import ModelClient


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="colloqua")
    parser.add_argument("--settings")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, *arguments in (("extract", "folder", "out"), ("preview", "path"), ("stats", "path"), ("sources", "folder"), ("count", "path")):
        command = commands.add_parser(name)
        for argument in arguments:
            command.add_argument(argument)
    cleaning = commands.add_parser("clean")
    cleaning.add_argument("method", choices=("raw", "llm"))
    cleaning.add_argument("path")
    cleaning.add_argument("out")
    cleaning.add_argument("--strategy", choices=("scoring", "segment"), default="scoring")
    cleaning.add_argument("--scored", help="where all pairs go with their scores")
    cleaning.add_argument("--accept", type=int)
    merging = commands.add_parser("merge")
    merging.add_argument("out")
    merging.add_argument("paths", nargs="+")
    merging.add_argument("--keep-copies", action="store_true")
    given = parser.parse_args(argv)
    settings, spark = load_settings(given.settings), local_session()
    try:
        if given.command == "extract":
            return 0 if pipeline.extract(spark, given.folder, given.out, settings) is not None else 1
        if given.command == "clean":
            if given.accept is not None:
                settings = dataclasses.replace(settings, accept_score=given.accept)
            judge = None
            if given.method == "llm" and settings.base_url:
                client = ModelClient(settings.base_url, settings.model, settings.api_key, retries=settings.retries, delay=settings.delay)
                judge = client.score if given.strategy == "scoring" else client.remove
            print(pipeline.clean(spark, given.path, given.out, judge, settings, given.strategy, given.scored))
        elif given.command == "merge":
            pipeline.merge(spark, given.paths, given.out, not given.keep_copies)
        elif given.command == "count":
            print(count_records(spark, given.path))
        elif given.command == "sources":
            source_catalogue(spark, given.folder).show()
        else:
            getattr(pipeline, given.command)(spark, given.path).show(truncate=False)
    finally:
        clean_shared(spark)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
