"""Moving files that a report names: into a quarantine folder, into folders by kind, or away.

The work runs in tasks on the file system that driver and executors share.  It is safe to
repeat: a file that an earlier attempt moved is reported as ``done already``.
"""

from __future__ import annotations

import os
import shutil
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.session import ship


def _move(root: Path, rel: str | None, to: str | None) -> str:
    source = (root / (rel or "")).resolve()
    if not rel or root not in source.parents:
        return "outside"
    if to is None:
        if not source.exists():
            return "missing"
        source.unlink(missing_ok=True)
        return "deleted"
    target = Path(to)
    if not source.exists():
        return "done already" if target.exists() else "missing"
    if target.exists():
        return "target exists"
    target.parent.mkdir(parents=True, exist_ok=True)
    try:
        os.link(source, target)  # fails, where a move would overwrite, if the target came up meanwhile
        source.unlink()
    except FileExistsError:
        return "target exists"
    except OSError:  # another device, or no hard links there
        shutil.move(source, target)
    return "moved"


def _carry_out(plan: DataFrame, root: str) -> DataFrame:
    """path, target, state of each row of ``plan`` (path, target)."""
    ship(plan.sparkSession)
    base = Path(root).resolve()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            state = [_move(base, p, t) for p, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(state, pa.string())], names=["path", "target", "state"])

    return plan.mapInArrow(run, "path string, target string, state string")


def quarantine(files: DataFrame, root: str, folder: str) -> DataFrame:
    """Move each distinct ``path`` (relative to ``root``) below ``folder``, keeping the path."""
    plan = files.select("path", F.concat(F.lit(folder.rstrip("/") + "/"), F.col("path")).alias("target")).distinct()
    return _carry_out(plan, root)


def delete(files: DataFrame, root: str) -> DataFrame:
    return _carry_out(files.select("path", F.lit(None).cast("string").alias("target")).distinct(), root)


def sort_into(files: DataFrame, root: str, folder: str, kind: Column) -> DataFrame:
    """Move each file into ``folder``/<kind>/<name>; files of no kind stay where they are."""
    name = F.element_at(F.split("path", "/"), -1)
    plan = files.where(kind.isNotNull()).select("path", F.concat_ws("/", F.lit(folder.rstrip("/")), kind, name).alias("target"))
    return _carry_out(plan.distinct(), root)
