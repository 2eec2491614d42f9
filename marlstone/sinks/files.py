"""Atomic files and guards."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame


class NothingToPublish(RuntimeError):
    pass


def write_atomic(path: str | Path, data: bytes) -> None:
    """All or nothing: a temporary file beside the target, flushed, then moved over it."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        os.replace(name, path)
    except BaseException:
        Path(name).unlink(missing_ok=True)
        raise


def output_dir(out: str | Path, dry_run: bool = False, space: str | None = None) -> Path:
    """Dry and single-space runs go to a staging folder."""
    return Path(out) / ".staging" if dry_run or space else Path(out)


def refuse_empty(events: DataFrame) -> DataFrame:
    if events.isEmpty():
        raise NothingToPublish("no event is left to publish")
    return events
