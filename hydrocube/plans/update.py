"""Incremental yearly updates: catalogue, batch, checks, manifest and backup of one year's window at a time."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import last_wins, missing_dates
from ..operators.select import date_states, islands, watermark
from ..schema import require_columns
from ..sources import files
from ..sources.catalogue import write_manifest
from ..sources.retry import year_lock
from .batch import Tracker, run_cube_batch
from .cube import Cube
from .tracker import YearWindow, progress, reconcile, recent_failures, requeue

CATALOGUE = "task_id string, date date, tile string, uri string"
NEEDED = ["task_id", "date", "tile", "uri"]


class UpdateError(RuntimeError):
    """An update that must not go on."""


def checkpoint_path(root: str, event: str, source: str, stage: str) -> str:
    return f"{root.rstrip('/')}/.checkpoints/{event}/{source}_{stage}.done"


def write_checkpoint(spark: SparkSession, root: str, event: str, source: str, stage: str) -> str:
    """Marks a stage (fetch, harmonise, archive) of an event as done."""
    path = checkpoint_path(root, event, source, stage)
    if not files.exists(spark, path):
        files.write_text(spark, path, "")
    return path


def is_checkpointed(spark: SparkSession, root: str, event: str, source: str, stage: str) -> bool:
    return files.exists(spark, checkpoint_path(root, event, source, stage))


def checksum(df: DataFrame) -> str:
    """A digest of a table's rows, whatever their order and files."""
    n = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(20,0)")).alias("s")).first()
    return hashlib.sha256(f"{n.n}:{n.s}".encode()).hexdigest()


def merged_catalogue(old: DataFrame, new: DataFrame, year: int) -> DataFrame:
    """The year's rows of both; of a (date, tile) that comes again the new row stays."""
    return last_wins(new.select(*NEEDED), old.select(*NEEDED), ["date", "tile"]).where(F.year("date") == year)


def refresh_catalogue(spark: SparkSession, uri: str, new: DataFrame, year: int) -> tuple[DataFrame, str]:
    """Merges new rows into a year's catalogue and puts it in place only after the candidate is valid: (catalogue, checksum)."""
    require_columns(new, NEEDED, f"the catalogue of {year}")
    old = spark.read.schema(CATALOGUE).parquet(uri) if files.exists(spark, uri) else spark.createDataFrame([], CATALOGUE)
    candidate = f"{uri.rstrip('/')}-candidate-{uuid.uuid4().hex}"
    merged_catalogue(old, new, year).repartitionByRange("date", "tile").sortWithinPartitions("date", "tile").write.parquet(candidate)
    fresh = spark.read.schema(CATALOGUE).parquet(candidate)
    rows = fresh.count()
    if not rows:
        files.delete(spark, candidate)
        raise UpdateError(f"the catalogue of {year} is empty after the merge")
    digest = checksum(fresh)
    files.swap(spark, candidate, uri, rows)
    return spark.read.schema(CATALOGUE).parquet(uri), digest


def backup_state(spark: SparkSession, sources: list[str], target: str) -> bool:
    """Copies what there is of the state to the backup folder; a failure is reported, not raised."""
    try:
        for s in sources:
            if files.exists(spark, s):
                files.copy(spark, s, f"{target.rstrip('/')}/{s.rstrip('/').rsplit('/', 1)[-1]}")
        return True
    except Exception:  # noqa: BLE001 - a backup must not hide the run's own result
        return False


def status_report(catalogue: DataFrame, tracker: DataFrame, archive: DataFrame) -> DataFrame:
    """One row: task counts, states of dates, missing runs of dates, the watermark and the last failures.

    catalogue: task_id, date; tracker: task_id, status, attempts; archive: date.
    """
    tasks = catalogue.select("task_id", "date").join(tracker.select("task_id", "status"), "task_id", "left")
    states = date_states(tasks)
    counts = states.groupBy("state").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("state", "n")))).alias("state_counts"))  # three states
    gaps = islands(missing_dates(catalogue, archive)).agg(F.array_sort(F.collect_list(F.struct("first", "last", "n_days"))).alias("missing_ranges"))  # bounded by the calendar
    failures = recent_failures(tracker.withColumn("finished_at", F.lit(None).cast("timestamp"))).agg(F.array_sort(F.collect_list("task_id")).alias("recent_failed"))  # five rows
    dates = archive.agg(F.countDistinct("date").alias("archive_dates"), F.min("date").alias("archive_first"), F.max("date").alias("archive_last"))
    out = progress(tasks)
    for part in (counts, gaps, failures, dates, watermark(tasks)):
        out = out.crossJoin(F.broadcast(part))  # one row each
    return out


@dataclass
class Update:
    """An update's folders and functions. listed(window) -> rows of CATALOGUE; produce(task) -> pixels."""

    spark: SparkSession
    source: str
    folder: str
    lock_folder: str
    listed: Callable[[YearWindow], DataFrame]
    produce: Callable[[dict], list[tuple]]
    retry_failed: bool = True
    attempts: int = 3
    wait: float = 1.0
    years: list[dict] = field(default_factory=list)

    def place(self, year: int, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{year}/{name}"

    def cube(self) -> Cube:
        return Cube(self.spark, f"{self.folder.rstrip('/')}/archive")

    def tracker(self, year: int) -> Tracker:
        return Tracker(self.spark, self.place(year, "tracker"))

    def run(self, windows: list[YearWindow]) -> dict:
        """Runs the windows in turn; the first that fails leaves a failure manifest and stops the run."""
        run_id = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S.%fZ")
        return {"run_id": run_id if windows else None, "status": "ok" if windows else "noop", "years": [self._year(w, run_id) for w in windows]}

    def _year(self, w: YearWindow, run_id: str) -> dict:
        body = {"run_id": run_id, "source": self.source, "year": w.year, "start": w.start, "end": w.end, "kind": w.kind}
        manifests, manifest = self.place(w.year, "manifests"), None
        try:
            with year_lock(self.lock_folder, w.year):
                body |= self._steps(w)
            body["status"] = "ok"
        except Exception as e:
            body |= {"status": "failed", "failed": repr(e)}
            raise
        finally:
            manifest = write_manifest(self.spark, manifests, run_id, body)
            kept = [self.place(w.year, "tracker"), self.place(w.year, "catalogue"), f"{manifests}/{manifest}"]
            saved = backup_state(self.spark, kept, f"{self.folder.rstrip('/')}/backup/{w.year}")
        if not saved:
            raise UpdateError(f"the state of {w.year} could not be backed up")
        return body

    def _steps(self, w: YearWindow) -> dict:
        catalogue, digest = refresh_catalogue(self.spark, self.place(w.year, "catalogue"), self.listed(w), w.year)
        tasks, tracker, cube = catalogue.where(F.col("date").between(F.lit(w.start), F.lit(w.end))), self.tracker(w.year), self.cube()
        if not self.retry_failed:
            tasks = tasks.join(tracker.read().where("status = 'FAILED'").select("task_id"), "task_id", "left_anti")
        plan = reconcile(tasks, tracker.read(), cube.dates(self.source))
        again = tasks.join(plan.where("action = 'requeue'").select("date"), "date", "left_semi")
        if again.limit(1).count():
            tracker.write(requeue(tracker.read(), again))
        final = run_cube_batch(self.source, tasks, cube, tracker, self.produce, attempts=self.attempts, wait=self.wait)
        states = tasks.join(tracker.read(), "task_id", "left")
        if open_ := states.where("status IS NULL").count():
            raise UpdateError(f"{open_} tasks of {w.year} are unresolved")
        end = watermark(catalogue.join(tracker.read().select("task_id", "status"), "task_id", "left")).first().watermark
        return {"checksum": digest, "rows": catalogue.count(), "total": final["total"], "done": final["done"], "failed_tasks": final["failed"], "watermark": end}

    def last_manifest(self, year: int) -> dict | None:
        found = files.names(self.spark, self.place(year, "manifests"))
        found = [n for n in found if n.endswith(".json")]
        return json.loads(files.read_text(self.spark, f"{self.place(year, 'manifests')}/{found[-1]}")) if found else None
