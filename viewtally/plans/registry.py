"""Names, row ids and functions of all reports."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODULES = (
    "base", "facts", "channels", "programs", "music", "live", "launcher", "logins", "users",
    "retention", "rollout", "quality", "crashes", "distributions", "identity", "streams", "stores",
)


@dataclass(frozen=True)
class Report:
    name: str
    rows: tuple[str, ...]
    run: Callable[..., DataFrame]


REPORTS: dict[str, Report] = {}


def report(name: str, *rows: str):
    """Register a report under its name; ``rows`` are the survey rows it is."""

    def register(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        if name in REPORTS:
            raise ValueError(f"report {name} exists")
        REPORTS[name] = Report(name, rows, fn)
        return fn

    return register


def load() -> dict[str, Report]:
    for module in MODULES:
        import_module(f"viewtally.plans.{module}")
    return REPORTS


def text_edges(df: DataFrame) -> DataFrame:
    """Dates and times as text, the form in which results are stored."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("string").alias(f.name)
            if f.dataType.typeName() in ("date", "timestamp", "timestamp_ntz")
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
