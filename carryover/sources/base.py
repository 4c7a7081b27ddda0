"""The pluggable source interface.

A source turns a reference string into a ``DataFrame`` and into names.  It
never touches data itself: ``read`` returns a lazy plan, so Catalyst can
push filters and prune columns into the scan of whatever consumes it.
New formats plug in either as another class here or, for formats Spark
cannot read, through Spark's Python Data Source API.
"""

from __future__ import annotations

from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame, SparkSession


@runtime_checkable
class Source(Protocol):
    kind: str

    def session_settings(self) -> dict[str, str]:
        """Spark settings this source needs at session build time."""
        ...

    def resolve(self, ref: str) -> str:
        """Readable, fully qualified name for ``ref``."""
        ...

    def target_name(self, ref: str) -> str:
        """Default target table name derived from ``ref``."""
        ...

    def read(self, spark: SparkSession, ref: str) -> DataFrame:
        """Lazy DataFrame over the table behind ``ref``."""
        ...
