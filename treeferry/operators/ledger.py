"""What a run means to do and what it has done, kept where a later run finds it.

A ledger is a folder. ``<run id>/intents`` holds the written copy work, before anything is
copied; ``<run id>/done`` a small file for every few finished copies of a task, put there by the
task itself, so that they outlive a driver that is killed. A run that goes on with an id first
finishes or undoes what was left between a temporary file and its place, then copies the rest.
"""

from __future__ import annotations

import io
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeferry.functions.paths import FILE
from treeferry.scratch import read_table
from treeferry.session import qualified
from treeferry.storage import Stores, make_directories

DONE_SCHEMA = "source string, destination string, len bigint, outcome string, bytes bigint"
INTENTS_SCHEMA = (
    "source string, destination string, file_type string, len bigint, action string, range_start bigint, file_len bigint, temp_path string"
)
# A task hands its finished copies on after so many, or so many seconds.
DONE_ROWS, DONE_SECONDS = 256, 5.0
# Attempts at a task whose temporary names are looked for, where Spark allows no more.
LEAST_ATTEMPTS = 4


@dataclass(frozen=True)
class Ledger:
    """The folder of one run id, as a URI."""

    folder: str
    options: dict | None = None

    @classmethod
    def of(cls, spark: SparkSession, ledger: str, run_id: str, options: dict | None = None) -> Ledger:
        if not run_id or "/" in run_id:
            raise ValueError("a ledger needs a run_id, without slashes")
        folder = f"{qualified(spark, ledger)[0].rstrip('/')}/{run_id}"
        made = cls(folder, options)
        make_directories(made.done_folder, options)
        return made

    @property
    def done_folder(self) -> str:
        return self.folder + "/done"

    def new_intents(self) -> str:
        return f"{self.folder}/intents/{uuid.uuid4().hex}"

    def has_intents(self) -> bool:
        store, path = Stores(self.options).at(self.folder + "/intents")
        return store.status(path) is not None

    def intents(self, spark: SparkSession) -> DataFrame:
        """The files that runs with this id meant to copy, or ranges of them."""
        return read_table(spark, self.folder + "/intents", INTENTS_SCHEMA)

    def done(self, spark: SparkSession) -> DataFrame:
        """The copies that are finished: each file once for a length that it had."""
        rows = read_table(spark, self.done_folder, DONE_SCHEMA)
        return rows.groupBy("source", "destination", "len").agg(F.max("outcome").alias("outcome"), F.max("bytes").alias("bytes"))


class DoneWriter:
    """Writes the finished copies of one task, a file for every few."""

    def __init__(self, at, folder: str):
        self.at, self.folder = at, folder
        self.rows: list[dict] = []
        self.since = time.monotonic()

    def add(self, row: dict) -> None:
        self.rows.append(row)
        if len(self.rows) >= DONE_ROWS or time.monotonic() - self.since > DONE_SECONDS:
            self.flush()

    def flush(self) -> None:
        import pyarrow as pa
        import pyarrow.parquet as pq

        self.since = time.monotonic()
        if not self.rows:
            return
        text, number = pa.string(), pa.int64()
        schema = pa.schema({"source": text, "destination": text, "len": number, "outcome": text, "bytes": number})
        data = io.BytesIO()
        pq.write_table(pa.Table.from_pylist(self.rows, schema), data)
        name = uuid.uuid4().hex + ".parquet"
        store, path = self.at(f"{self.folder}/{name}")
        # Readers pass over names that begin so, and a writer may die in the middle.
        hidden = path if store.appears_when_closed else self.at(f"{self.folder}/_{name}")[1]
        with store.open_fresh(hidden) as file:
            view = memoryview(data.getvalue())
            while len(view):
                view = view[file.write(view) :]
        if hidden != path:
            store.rename(hidden, path, replace=False)
        self.rows = []


def finish_or_undo(attempts: int):
    """What to do about one intent that is not known to be done. A whole temporary file goes
    into its place if nothing is there, as where a run broke off between a deletion and a
    rename. Any other one goes: what is in its place, old or new, stays."""

    def act(task, row: dict) -> dict:
        store, path = task.at(row["destination"])
        cut = row["range_start"] is not None  # its length says nothing: ranges are written in any order
        names = [row["temp_path"]] if cut else [f"{row['temp_path']}.{n}" for n in range(attempts)]
        outcome = "untouched"
        for name in names:
            _, temp = task.at(name)
            found = store.status(temp)
            if not found:
                continue
            if not cut and found == (FILE, row["file_len"]) and not store.status(path):
                store.rename(temp, path, replace=False)
                outcome = "finished"
                continue
            store.remove_file(temp)
            outcome = "undone" if outcome == "untouched" else outcome
        return {"outcome": outcome, "bytes": row["file_len"] if outcome == "finished" else None}

    return act


def attempts_of(spark: SparkSession) -> int:
    return max(LEAST_ATTEMPTS, int(spark.conf.get("spark.task.maxFailures", str(LEAST_ATTEMPTS))))
