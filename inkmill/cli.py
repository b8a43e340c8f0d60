"""Jobs from the command line: `python -m inkmill.cli JOB [--config FILE] [--key value ...]`.

A config file is YAML with the same keys; the command line wins. `backend` and `converter` are `module:name`. Jobs that
generate take `model_name` and `base_url` instead of a backend: a chat endpoint, by default the one on this machine.
"""

from __future__ import annotations

import argparse
import functools
import importlib
import inspect
import logging

from pyspark.sql import SparkSession

from inkmill.operators.chat import URL, ChatGenerator
from inkmill.plans import jobs
from inkmill.plans.ship import ship

JOBS = {"create": jobs.create, "create_reasoning": jobs.create_reasoning, "convert": jobs.convert, "summarize": jobs.summaries, "merge": jobs.merge_csv, "pdf2md": jobs.documents_to_markdown, "ragval": jobs.rag_questions}


def _named(value: str) -> object:
    module, _, name = value.partition(":")
    return getattr(importlib.import_module(module), name)


def _flag(value: str | bool) -> bool:
    return value if isinstance(value, bool) else value.lower() in ("1", "true", "yes")


def _keys(job) -> list[str]:
    known = list(inspect.signature(job).parameters)[1:]
    return known + ["model_name", "base_url"] * ("backend" in known) + ["convert"] * ("convert_first" in known)


def parse(args: list[str]) -> tuple[str, dict[str, object]]:
    top = argparse.ArgumentParser(prog="inkmill")
    subs = top.add_subparsers(dest="job", required=True)
    for name, job in JOBS.items():
        sub = subs.add_parser(name, help=(job.__doc__ or "").splitlines()[0])
        sub.add_argument("--config")
        for key in _keys(job):
            sub.add_argument(f"--{key}")
    given = vars(top.parse_args(args))
    name, config = given.pop("job"), given.pop("config")
    values: dict[str, object] = {}
    if config:
        import yaml

        with open(config) as f:
            values |= yaml.safe_load(f) or {}
    values |= {k: v for k, v in given.items() if v is not None}
    known = inspect.signature(JOBS[name]).parameters
    if unknown := set(values) - set(_keys(JOBS[name])):
        raise SystemExit(f"unknown keys for {name}: {sorted(unknown)}")
    if "convert" in values:
        values["convert_first"] = values.pop("convert")
    model, url = values.pop("model_name", None), values.pop("base_url", URL)
    if model and "backend" not in values:
        values["backend"] = functools.partial(ChatGenerator, model, url)
    if "backend" in known and "backend" not in values:
        raise SystemExit(f"{name} needs --model_name or --backend")
    for key, value in values.items():
        default = known[key].default
        if key in ("backend", "converter") and isinstance(value, str):
            values[key] = _named(value)
        elif isinstance(default, bool):
            values[key] = _flag(value)
        elif isinstance(default, int):
            values[key] = int(value)
    return name, values


def main(args: list[str] | None = None) -> None:
    name, values = parse(args if args is not None else __import__("sys").argv[1:])
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = SparkSession.builder.appName(f"inkmill {name}").getOrCreate()
    ship(spark)
    JOBS[name](spark, **values)


if __name__ == "__main__":
    main()
