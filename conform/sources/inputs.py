"""What the planner knows of an input, before anything of it is read."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from conform.sources.workspace import stored

_UNITS = {unit: 1024**power for power, unit in enumerate(("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"))}
_NODE = re.compile(r"^[\s:+|-]*(\w+)\b.*?Statistics\(sizeInBytes=([\d.]+) (\w+)", re.MULTILINE)
_COLUMNAR = re.compile(r"\] (?:parquet|orc), Statistics")


@dataclass(frozen=True)
class Planned:
    """The bytes that the planner expects, None where it cannot know, and whether another run costs a scan at most."""

    size: int | None
    light: bool


def planned(df: DataFrame) -> Planned:
    """What ``EXPLAIN COST`` says of the plan; no job is run.

    A plan is light if it only projects and filters stored columns, or a few rows known to the planner. Delimited text is
    not: its lines would be parsed again. Sizes of joins are products in an estimate, and filters count for nothing in it, so
    there is a size for scans and projections alone: the files' own, which memory will not undercut.
    """
    text = df.sparkSession.sql("EXPLAIN COST SELECT * FROM {df}", df=df).first()[0]
    nodes = _NODE.findall(text.split("== Physical Plan ==")[0])
    scans = sum(name in ("Relation", "RelationV2") for name, _, _ in nodes)
    light = {name for name, _, _ in nodes} <= {"Project", "Filter", "Relation", "LocalRelation", "Range", "Union"}
    light = light and bool(nodes) and scans == len(_COLUMNAR.findall(text.split("== Physical Plan ==")[0]))
    sized = light and "Filter" not in {name for name, _, _ in nodes}
    size = round(float(nodes[0][1]) * _UNITS[nodes[0][2]]) if sized else None
    return Planned(size, light)


def settled(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` itself if its plan is light, else its rows stored, so that what it is made of is read and computed once."""
    return df if planned(df).light else stored(df, purpose)
