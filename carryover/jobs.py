"""Job labels, scheduler pools, deadlines and retries for work submitted from driver threads.

Spark keeps these as thread-local properties, so each batch or check
thread labels its own jobs (visible in the event log and history server)
and, when the session runs the FAIR scheduler, puts them in a named pool.
"""

from __future__ import annotations

import contextlib
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


@contextlib.contextmanager
def labelled(spark: SparkSession, description: str, pool: str | None = None) -> Iterator[None]:
    """Label the jobs started inside the block; restore the thread's previous labels after."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext; labels are optional
        yield
        return
    old_desc = sc.getLocalProperty("spark.job.description")
    old_pool = sc.getLocalProperty("spark.scheduler.pool")
    sc.setLocalProperty("spark.job.description", description)
    if pool:
        sc.setLocalProperty("spark.scheduler.pool", pool)
    try:
        yield
    finally:
        sc.setLocalProperty("spark.job.description", old_desc)  # type: ignore[arg-type]
        if pool:
            sc.setLocalProperty("spark.scheduler.pool", old_pool)  # type: ignore[arg-type]


class DeadlineExceeded(RuntimeError):
    """Work was cancelled because it ran longer than it was allowed to."""


@contextlib.contextmanager
def deadline(spark: SparkSession, seconds: float | None) -> Iterator[None]:
    """Cancel the Spark jobs started inside the block once ``seconds`` have passed.

    The thread's jobs carry a tag of their own (broadcasts and subqueries
    inherit it); when time is up a watcher cancels all jobs of that tag, and again
    whatever the block still starts, until it has ended.  What it then raises becomes
    :class:`DeadlineExceeded`; work that finishes all the same counts as finished.
    Jobs of other threads are not touched.
    """
    if seconds is None:
        yield
        return
    sc, tag = spark.sparkContext, f"carryover-{uuid.uuid4().hex}"
    ended, late = threading.Event(), threading.Event()

    def watch() -> None:
        if ended.wait(seconds):
            return
        late.set()
        while not ended.is_set():
            sc.cancelJobsWithTag(tag)
            ended.wait(0.2)

    watcher = threading.Thread(target=watch, name=f"deadline of {tag}", daemon=True)
    sc.addJobTag(tag)
    watcher.start()
    try:
        yield
    except Exception as exc:
        if late.is_set():
            raise DeadlineExceeded(f"cancelled after {seconds:g} s") from exc
        raise
    finally:
        ended.set()
        watcher.join()
        sc.removeJobTag(tag)


#: What a lost machine, a slow network or a busy store looks like in an error's text.
PASSING = (
    "ExecutorLostFailure", "FetchFailed", "Connection refused", "Connection reset", "ConnectException",
    "SocketTimeoutException", "NoRouteToHostException", "UnknownHostException", "SlowDown", "Service Unavailable",
    "Too Many Requests", "RpcTimeoutException", "Executor heartbeat timed out",
)


def may_pass(exc: BaseException) -> bool:
    """Whether the same work may succeed if tried again: lost machines, networks and stores, never bad SQL or data."""
    if isinstance(exc, (DeadlineExceeded, ValueError, TypeError, KeyError)):
        return False
    if isinstance(exc, (ConnectionError, TimeoutError)):
        return True
    state = getattr(exc, "getSqlState", lambda: None)()
    if state and str(state)[:2] in ("22", "42"):  # data exceptions; syntax, names and rights
        return False
    return any(sign in str(exc) for sign in PASSING)
