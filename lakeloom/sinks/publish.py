"""Versions of a set of tables, published after their checks.

Tables are built in a folder of their own version, which no reader knows. When all are
written and the checks have passed, a small pointer file is replaced by one that names the
version. A reader resolves the pointer once and then reads one whole version: it never
sees tables of two runs, and a run that fails its checks, or breaks, leaves the last
published version as it is.

Pointers are numbered files (the latest counts), because no file system replaces a file
and keeps it readable in the same way as all others, while each can create one that was
not there. The names of versions say nothing about their order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakeloom.operators.quality import require
from lakeloom.sinks.storage import Folders

VERSIONS, POINTERS = "versions", "published"


@dataclass(frozen=True)
class Release:
    """A version on its way: tables are written below ``path``."""

    root: str
    version: str

    @property
    def path(self) -> str:
        return f"{self.root}/{VERSIONS}/{self.version}"

    def table(self, name: str) -> str:
        return f"{self.path}/{name}"


def new_release(root: str) -> Release:
    return Release(root.rstrip("/"), uuid.uuid4().hex)


def _pointers(folders: Folders, root: str) -> list[int]:
    """Numbers of the pointers, each a folder with one small file, so that a listing shows them."""
    return sorted(int(name) for name in folders.folders(f"{root}/{POINTERS}") if name.isdigit())


def published(spark: SparkSession, root: str) -> Release | None:
    """The version that readers should read, or None if none was published."""
    root, folders = root.rstrip("/"), Folders(spark, root)
    for number in reversed(_pointers(folders, root)):
        return Release(root, folders.read_text(f"{root}/{POINTERS}/{number}/version").strip())
    return None


def publish(spark: SparkSession, release: Release, keep: int = 2) -> None:
    """Make ``release`` the version that readers find; older ones than the last ``keep`` go.

    The pointer is written at the side and moved to the next number: the move fails if
    another run has taken it, so of two runs at once one is told.
    """
    if keep < 1:
        raise ValueError("keep at least the version that is published")
    root, folders = release.root, Folders(spark, release.root)
    numbers = _pointers(folders, root)
    number = numbers[-1] + 1 if numbers else 1
    side = f"{root}/_{POINTERS}-{release.version}"
    folders.make(side)
    folders.write_text(f"{side}/version", release.version)
    folders.make(f"{root}/{POINTERS}")
    place = f"{root}/{POINTERS}/{number}"
    folders.move(side, place)
    if folders.read_text(f"{place}/version").strip() != release.version:
        raise OSError(f"another run published at the same time as {release.version}")
    for old in numbers[: max(0, len(numbers) + 1 - keep)]:
        version = folders.read_text(f"{root}/{POINTERS}/{old}/version").strip()
        folders.delete(f"{root}/{VERSIONS}/{version}")
        folders.delete(f"{root}/{POINTERS}/{old}")


def read_published(spark: SparkSession, root: str, schemas: Mapping[str, StructType]) -> dict[str, DataFrame]:
    """All tables of one published version."""
    release = published(spark, root)
    if release is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    return {name: spark.read.schema(schema).parquet(release.table(name)).select(*schema.fieldNames()) for name, schema in schemas.items()}


def publish_checked(
    spark: SparkSession, root: str, build: Callable[[Release], Mapping[str, DataFrame]], checks: Callable[[Mapping[str, DataFrame]], DataFrame], keep: int = 2
) -> tuple[Mapping[str, DataFrame], Release]:
    """Build a version, check its stored tables, publish it. ``build`` writes the tables and
    returns them as read back. If it breaks or a check fails, the version is removed, the
    error is raised and what was published before stays."""
    release = new_release(root)
    try:
        tables = build(release)
        require(checks(tables))
    except Exception:
        Folders(spark, release.root).delete(release.path)
        raise
    publish(spark, release, keep)
    return tables, release
