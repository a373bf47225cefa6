"""One audit row per run, whether it succeeds or fails."""

import logging
import uuid
from contextlib import contextmanager
from datetime import datetime, timezone

from verbalance import fixed
from verbalance.schemas import RUN_AUDIT
from verbalance.sinks import control
from verbalance.sources.records import rows_frame

_log = logging.getLogger(__name__)
COUNTS = (
    "bronze_record_count",
    "silver_record_count",
    "joined_record_count",
    "final_record_count",
)


def utc_now():
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Run:
    """Identity and stage counts of a run; counts not reached stay NULL."""

    def __init__(self, run_id, started):
        self.run_id = run_id
        self.started = started
        self.counts = {}

    def record(self, **counts):
        unknown = set(counts) - set(COUNTS)
        if unknown:
            raise ValueError(f"not a stage count: {sorted(unknown)}")
        self.counts.update(counts)

    def row(self, status, ended, error=None):
        return {
            "run_id": self.run_id,
            "run_start_time": self.started,
            "run_end_time": ended,
            "run_duration_seconds": (ended - self.started).total_seconds(),
            "run_status": status,
            **self.counts,
            "error_message": None if error is None else str(error),
            "error_type": None if error is None else type(error).__name__,
        }


def close_lost_runs(spark, append, markers, clock=utc_now):
    """Append a FAILED row for each run that left its marker behind: its driver was lost.

    A run whose row was appended before its driver was lost keeps that row. Runs that share a
    folder of markers must not overlap.
    """
    for name in sorted(n for n in control.names(spark, markers) if n.endswith(".json")):
        lost = control.read_json(spark, f"{markers}/{name}")
        run = Run(lost["run_id"], datetime.fromisoformat(lost["run_start_time"]))
        error = RunLost("the run did not come to its end")
        append(rows_frame(spark, [run.row(fixed.RUN_FAILED, clock(), error)], RUN_AUDIT))
        control.remove(spark, f"{markers}/{name}")


class RunLost(RuntimeError):
    """The driver of a run was lost."""


@contextmanager
def audited_run(spark, append, clock=utc_now, run_id=None, markers=None):
    """Run a block and append its audit row by ``append(frame)``.

    An exception in the block is recorded as a FAILED row and raised again. If
    that row cannot be written, the problem is logged and the first exception
    still comes through. With a folder of ``markers`` a run leaves a marker there until its row
    is written; the next run closes those that were left behind.
    """
    if markers:
        close_lost_runs(spark, append, markers, clock)
    run = Run(run_id or str(uuid.uuid4()), clock())
    marker = f"{markers}/{run.run_id}.json"
    if markers:
        begun = {"run_id": run.run_id, "run_start_time": run.started.isoformat()}
        control.write_json(spark, marker, begun)
    try:
        yield run
    except BaseException as error:
        try:
            append(rows_frame(spark, [run.row(fixed.RUN_FAILED, clock(), error)], RUN_AUDIT))
        except Exception:
            _log.exception("audit row of failed run %s was not written", run.run_id)
        else:
            if markers:
                control.remove(spark, marker)
        raise
    append(rows_frame(spark, [run.row(fixed.RUN_SUCCESS, clock())], RUN_AUDIT))
    if markers:
        control.remove(spark, marker)
