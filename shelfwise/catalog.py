"""Registry of the reports by key.

A report is a plain function over DataFrames; the names of its parameters without a
default say which workspace tables it reads.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .workspace import Workspace

REPORTS: dict[str, Callable[..., DataFrame]] = {}
# Tables that several reports start from, stored by the workspace on first use.
TABLES: dict[str, Callable[..., DataFrame]] = {}


def report(key: str):
    def register(fn):
        if key in REPORTS:
            raise ValueError(f"report {key} is registered twice")
        REPORTS[key] = fn
        return fn
    return register


def table(name: str):
    """Register a stored table; reports and other tables name it as a parameter."""
    def register(fn):
        TABLES[name] = fn
        return fn
    return register


def run(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run a report on the tables of a source folder."""
    return call(REPORTS[key], Workspace(spark, sf_dir))


def call(fn: Callable[..., DataFrame], workspace: Workspace) -> DataFrame:
    """Call a report with the workspace tables its parameters name."""
    def given(name: str):
        if name == "workspace":
            return workspace
        if name in TABLES:
            return workspace.stored(name, lambda: call(TABLES[name], workspace))
        return getattr(workspace, name)()

    return fn(**{n: given(n) for n, p in inspect.signature(fn).parameters.items() if p.default is inspect.Parameter.empty})
