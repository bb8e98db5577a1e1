"""What both jobs share: their command line, configuration and log."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable

import yaml
from pyspark.sql import SparkSession

from skiagram.session import session


def settings(spark: SparkSession, path: str, known: dict) -> dict:
    """A YAML file, which may be remote, over the job's own defaults; names that it doesn't know are an error."""
    told = yaml.safe_load(spark.read.text(path, wholetext=True).first()[0]) or {}
    if unknown := sorted(set(told) - set(known)):
        raise ValueError(f"{path}: unknown settings {unknown}; known ones are {sorted(known)}")
    return known | told


def command_line(about: str, inputs: dict[str, str], config: str, known: dict, job: Callable[..., dict], argv: list[str] | None) -> int:
    """Creates a session, runs the job and stops the session."""
    p = argparse.ArgumentParser(description=about)
    for name, what in inputs.items():
        p.add_argument(f"--{name}", required=True, help=what)
    p.add_argument("--out", required=True, help="folder of the output and, for a stream, of its checkpoint")
    p.add_argument("--config", default=config, help="YAML file of settings")
    p.add_argument("--master", help="Spark master, where the environment doesn't tell")
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = session(a.master)
    try:
        job(spark, *(getattr(a, name) for name in inputs), a.out, settings(spark, a.config, known))
    finally:
        spark.stop()
    return 0
