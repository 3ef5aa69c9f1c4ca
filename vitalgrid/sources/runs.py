"""Runs that are there whole or not at all.

A run writes several folders: predictions, alerts, alert lines, summary. Before the first
of them it leaves a mark that names them all, after the last a manifest, and then the mark
goes. A run with a mark and no manifest is unfinished: readers pass over it, and
``recover`` deletes what it left. Mark and manifest are small files beside the runs, in
a folder that Spark's readers do not look into; each is renamed into its place when
written. A run without either, from before or from elsewhere, counts as finished.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from vitalgrid.session import delete, exists, list_folder, put_text, read_text

FOLDER = "_runs"
MARK, MANIFEST = ".open", ".json"
DAY = 86_400.0


def _file(base: str, run_id: str, ending: str) -> str:
    return f"{base.rstrip('/')}/{FOLDER}/{run_id}{ending}"


def _names(spark: SparkSession, base: str, ending: str) -> dict[str, int]:
    """Run ids that have such a file, and when it was written, in milliseconds."""
    found = list_folder(spark, f"{base.rstrip('/')}/{FOLDER}")
    return {e.name[: -len(ending)]: e.modified for e in found if e.name.endswith(ending)}


@dataclass
class Run:
    """A run while it is written. ``rows`` are counts for the manifest."""

    spark: SparkSession
    base: str
    run_id: str
    folders: list[str]
    claims: list[str] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)

    def mark(self) -> None:
        text = json.dumps({"run_id": self.run_id, "folders": self.folders, "claims": self.claims})
        put_text(self.spark, _file(self.base, self.run_id, MARK), text, replace=True)

    def commit(self) -> None:
        text = json.dumps({"run_id": self.run_id, "folders": self.folders, "rows": self.rows, "finished": time.time()})
        put_text(self.spark, _file(self.base, self.run_id, MANIFEST), text, replace=True)
        delete(self.spark, _file(self.base, self.run_id, MARK))


@contextmanager
def run(spark: SparkSession, base: str, run_id: str, folders: list[str], replace: bool = False) -> Iterator[Run]:
    """Mark, let the caller write ``folders``, commit. If the caller fails, the mark stays
    and the run is unfinished. A finished run is an error unless it is to be replaced;
    it is gone for readers from then until the new one is whole."""
    if exists(spark, _file(base, run_id, MANIFEST)) and not replace:
        raise FileExistsError(f"the run {run_id} exists")
    begun = Run(spark, base, run_id, folders)
    begun.mark()
    delete(spark, _file(base, run_id, MANIFEST))
    yield begun
    begun.commit()


def unfinished(spark: SparkSession, base: str) -> set[str]:
    """Runs with a mark and no manifest."""
    marked = _names(spark, base, MARK)
    return set(marked) - set(_names(spark, base, MANIFEST)) if marked else set()


def manifests(spark: SparkSession, base: str) -> DataFrame:
    """One row per manifest: run_id, folders, rows, finished (seconds)."""
    schema = "run_id string, folders array<string>, rows map<string, bigint>, finished double"
    if not _names(spark, base, MANIFEST):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{base.rstrip('/')}/{FOLDER}/*{MANIFEST}")


def recover(spark: SparkSession, base: str, older_than: float = DAY, now: Callable[[], float] = time.time) -> list[str]:
    """Delete what unfinished runs have left and give back the inputs that they claimed;
    their ids. A younger mark may be that of a run still at work and is left alone."""
    gone = []
    written = _names(spark, base, MARK)
    for run_id in sorted(unfinished(spark, base)):
        if now() - written[run_id] / 1000 < older_than:
            continue
        mark = json.loads(read_text(spark, _file(base, run_id, MARK)))
        for folder in mark["folders"]:
            delete(spark, folder)
        for claim in mark["claims"]:
            if exists(spark, claim) and read_text(spark, claim) == run_id:
                delete(spark, claim)
        delete(spark, _file(base, run_id, MARK))
        gone.append(run_id)
    # A mark beside its manifest was left by a run that ended between the two.
    for run_id in set(written) & set(_names(spark, base, MANIFEST)):
        delete(spark, _file(base, run_id, MARK))
    return gone
