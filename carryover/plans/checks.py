"""V1–V5: run a file of SQL checks and report each as a row.

Check file format (V4), kept from the reference:

* a statement ends at a blank line (not at ``;``); one statement per block;
* ``-- ASSERT: text`` makes the next statement an assertion labelled
  ``text``; the label survives blank lines and comments until a statement
  comes;
* other whole-line ``--`` comments are dropped.

An assertion (V2) passes when the first column of its first row is true
(booleans; non-zero numbers).  No rows, NULL, false, 0, a string, or an
error fail it.  Only the first row is judged; a second row is noted.
An information query (V3) passes if it runs to its end: all its rows are
computed on the executors, once (they are kept on the executors' disks for as long as
the check takes), then a bounded sample of them is fetched for
display, and its DataFrame is handed back.

``run_checks(fuse=True)`` answers all plain assertions over a table by one scan
(:mod:`.fuse`); the report is the same.

The statements themselves are Spark SQL, so every check runs as Spark
jobs over the tables it names; the driver sees at most two rows of an
assertion and ``sample_rows`` rows of an information query.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions.names import quote_ref, split_ref, sql_string
from ..functions.truth import judge

ASSERT_PREFIX = "-- ASSERT:"

REPORT_SCHEMA = StructType(
    [
        StructField("position", IntegerType(), False),
        StructField("label", StringType(), False),
        StructField("kind", StringType(), False),
        StructField("status", StringType(), False),
        StructField("detail", StringType(), True),
    ]
)


@dataclass(frozen=True)
class Check:
    sql: str
    assert_msg: str | None = None

    @property
    def is_assertion(self) -> bool:
        return self.assert_msg is not None


def parse_checks(text: str) -> list[Check]:
    """V4: split check text into statements and attach ``-- ASSERT:`` labels.

    The text is cut into segments of consecutive non-blank lines.  Inside a
    segment, ``-- ASSERT:`` lines set the pending label (the last one wins),
    other ``--`` lines are dropped, and the rest is the statement.  A segment
    with a statement emits one check and clears the label; a segment of only
    comments leaves the label pending for the next statement.
    """
    checks: list[Check] = []
    label: str | None = None
    for non_blank, group in itertools.groupby(text.splitlines(), key=lambda line: bool(line.strip())):
        if not non_blank:
            continue
        statement: list[str] = []
        for line in group:
            head = line.strip()
            if head.startswith(ASSERT_PREFIX):
                label = head[len(ASSERT_PREFIX):].strip()
            elif not head.startswith("--"):
                statement.append(line)
        if statement:
            checks.append(Check("\n".join(statement), label))
            label = None
    return checks


def load_checks(path: str | Path) -> list[Check]:
    """Read a check file (a small text file on the driver)."""
    p = Path(path)
    if not p.exists():
        raise FileNotFoundError(f"check file not found: {p}")
    return parse_checks(p.read_text())


@dataclass
class CheckRun:
    report: DataFrame
    info: dict[str, DataFrame] = field(default_factory=dict)
    samples: dict[str, list] = field(default_factory=dict)
    passed: int = 0
    failed: int = 0

    @property
    def exit_code(self) -> int:
        """V5: 1 if any check failed, else 0 (also 0 for an empty check list)."""
        return 1 if self.failed else 0


def _error_text(exc: BaseException) -> str:
    return str(exc).strip() or type(exc).__name__


def _judged(head: list) -> tuple[str, str]:
    """Status and detail of an assertion by its first rows (two at most)."""
    if not head:
        ok, detail = False, "query returned no rows"
    else:
        ok, detail = judge(head[0][0])
        if not ok:
            detail = f"{detail}; first row {head[0].asDict()!r}"
        if len(head) > 1:
            detail = (detail + "; " if detail else "") + "more than one row, first judged"
    return ("passed" if ok else "failed"), detail


def _run_once(df: DataFrame, sample_rows: int) -> list[dict]:
    """Compute all rows on the executors, in one run, and fetch a sample of them."""
    kept = df.persist(StorageLevel.DISK_ONLY)
    try:
        kept.write.format("noop").mode("overwrite").save()
        return [r.asDict() for r in kept.take(sample_rows)]
    finally:
        kept.unpersist()


def _run_one(spark: SparkSession, i: int, check: Check, sample_rows: int) -> tuple[tuple, DataFrame | None, list | None]:
    label = check.assert_msg or f"Query #{i}"
    kind = "assert" if check.is_assertion else "info"
    info_df = sample = None
    try:
        df = spark.sql(check.sql)
        if check.is_assertion:
            status, detail = _judged(df.take(2))
        else:
            sample = _run_once(df, sample_rows)
            info_df = df
            status, detail = "passed", ""
    except Exception as exc:  # noqa: BLE001 - a failing check must not stop the run
        status, detail = "error", _error_text(exc)
    return (i, label, kind, status, detail or None), info_df, sample


def _run_fused(spark: SparkSession, checks: Sequence[Check], each) -> dict[int, tuple]:
    """Results by position (from 1) of the assertions that one scan a table can answer."""
    from .fuse import fuse

    fused = fuse(spark, [c.sql if c.is_assertion else None for c in checks])

    def scan(key: tuple[str, ...]):
        try:
            return fused.queries[key].first()
        except Exception:  # noqa: BLE001 - some expression failed: its checks run alone
            return None

    rows = dict(zip(fused.queries, each(scan, list(fused.queries), lambda key: f"{'.'.join(key)}, all assertions")))
    rows = {key: row for key, row in rows.items() if row is not None}
    ready = [i for i in fused.plain if fused.tables_of(i) <= rows.keys()]
    if not ready:
        return {}
    answers = fused.answers(spark, rows)

    try:  # all expressions over the one row of answers at once
        values = answers.selectExpr(*(fused.expression(i) for i in ready)).first()
        heads = {i: Row(fused.plain[i].name)(value) for i, value in zip(ready, values)}
    except Exception:  # noqa: BLE001 - some expression failed: its check runs alone
        heads = {}
        for i in ready:
            try:
                heads[i] = answers.selectExpr(fused.expression(i)).first()
            except Exception:  # noqa: BLE001
                continue
    out = {}
    for i, head in heads.items():
        status, detail = _judged([head])
        out[i + 1] = ((i + 1, checks[i].assert_msg or f"Query #{i + 1}", "assert", status, detail or None), None, None)
    return out


def run_checks(
    spark: SparkSession,
    checks: Sequence[Check],
    *,
    sample_rows: int = 20,
    parallelism: int = 1,
    scheduler_pool: str | None = None,
    fuse: bool = False,
) -> CheckRun:
    """V1: run each check with ``spark.sql``; one report row per check, in file order.

    Statuses: ``passed``, ``failed`` (assertion false / empty / not boolean)
    and ``error`` (the statement did not run).  Errors count as failures.
    Checks are independent queries, so ``parallelism > 1`` runs that many
    at once from driver threads (each a Spark job over its tables).
    ``fuse=True`` first answers the plain assertions of each table by one scan of it.
    """
    from ..jobs import labelled

    def each(run, items: list, label) -> list:
        def one(item):
            with labelled(spark, f"carryover check {label(item)}", scheduler_pool):
                return run(item)

        if parallelism > 1 and len(items) > 1:
            from concurrent.futures import ThreadPoolExecutor

            with ThreadPoolExecutor(max_workers=parallelism) as pool:
                return list(pool.map(one, items))
        return [one(item) for item in items]

    done = _run_fused(spark, checks, each) if fuse else {}
    alone = [(i, c) for i, c in enumerate(checks, 1) if i not in done]
    ran = each(lambda item: _run_one(spark, *item, sample_rows), alone, lambda item: f"{item[0]}: {item[1].assert_msg or 'information query'}")
    done |= dict(zip([i for i, _ in alone], ran))
    results = [done[i] for i in sorted(done)]
    rows = [r for r, _, _ in results]
    info = {r[1]: df for r, df, _ in results if df is not None}
    samples = {r[1]: s for r, _, s in results if s is not None}
    passed = sum(1 for r in rows if r[3] == "passed")
    report = spark.createDataFrame(rows, REPORT_SCHEMA)
    return CheckRun(report=report, info=info, samples=samples, passed=passed, failed=len(rows) - passed)


def run_check_file(spark: SparkSession, path: str | Path, **kwargs) -> CheckRun:
    """V1+V4+V5 together: a missing file is an error, an empty file passes."""
    return run_checks(spark, load_checks(path), **kwargs)


# --- the reference's four assertion kinds and its information query, as check text ---


def count_equal_sql(source: str, target: str) -> str:
    """Source and target have the same number of rows (two scalar subqueries, J1/T9)."""
    return (
        f"SELECT (SELECT count(*) FROM {quote_ref(source)}) = "
        f"(SELECT count(*) FROM {quote_ref(target)}) AS ok"
    )


def non_empty_sql(table: str) -> str:
    """A4: the table has rows."""
    return f"SELECT count(*) > 0 AS ok FROM {quote_ref(table)}"


def distinct_partitions_sql(table: str, column: str) -> str:
    """A5: the partition column has values."""
    return f"SELECT count(DISTINCT {quote_ref([column])}) > 0 AS ok FROM {quote_ref(table)}"


def partition_has_rows_sql(table: str, column: str, value: str) -> str:
    """One named partition has rows (a pruned read)."""
    return f"SELECT count(*) > 0 AS ok FROM {quote_ref(table)} WHERE {quote_ref([column])} = {sql_string(value)}"


def info_sql(
    tables: Iterable[tuple[str, str] | tuple[str, str, str | None]],
    partition_column: str | None = None,
    *,
    count_alias: str = "n_rows",
) -> str:
    """One summary row per ``(label, table[, partition column])``, glued with ``UNION ALL``.

    With a partition column (per table, or ``partition_column`` for all),
    each row also carries ``count(DISTINCT column) AS partitions``.
    """
    items = [(i[0], i[1], i[2] if len(i) > 2 else partition_column) for i in tables]  # type: ignore[misc]
    any_partitions = any(column for _, _, column in items)
    parts = []
    for label, table, column in items:
        extra = ""
        if column:
            extra = f", count(DISTINCT {quote_ref([column])}) AS partitions"
        elif any_partitions:  # keep every UNION ALL branch the same width
            extra = ", CAST(NULL AS BIGINT) AS partitions"
        parts.append(
            f"SELECT {sql_string(label)} AS tbl, count(*) AS {quote_ref([count_alias])}{extra} FROM {quote_ref(table)}"
        )
    if not parts:
        raise ValueError("no tables")
    return " UNION ALL ".join(parts)


def copy_check_text(pairs: Iterable[tuple[str, str]]) -> str:
    """Check text for copied tables: counts equal, target not empty, and a summary query."""
    pairs = list(pairs)
    blocks = []
    for source, target in pairs:
        blocks.append(f"-- ASSERT: {target} row count matches {source}\n{count_equal_sql(source, target)}")
    for _, target in pairs:
        blocks.append(f"-- ASSERT: {target} is not empty\n{non_empty_sql(target)}")
    blocks.append(info_sql([(split_ref(t)[-1], t) for _, t in pairs]))
    return "\n\n".join(blocks) + "\n"


def register_check_text(tables: Iterable[str], column: str, value: str) -> str:
    """Check text for registered tables: not empty, partitions present, one partition has rows."""
    tables = list(tables)
    blocks = []
    for t in tables:
        blocks.append(f"-- ASSERT: {t} is not empty\n{non_empty_sql(t)}")
    for t in tables:
        blocks.append(f"-- ASSERT: {t} has {column} values\n{distinct_partitions_sql(t, column)}")
    for t in tables:
        blocks.append(f"-- ASSERT: {t} partition {column}={value} has rows\n{partition_has_rows_sql(t, column, value)}")
    blocks.append(info_sql([(split_ref(t)[-1], t) for t in tables], partition_column=column))
    return "\n\n".join(blocks) + "\n"
