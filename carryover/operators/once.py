"""K3, O2: appends that can be repeated: a load id counts once.

A *ledger* table beside the target (``carryover_loads`` in its database) notes what became of
every load: ``begun``, ``staged`` with the rows and fingerprint that its write observed, ``done``.
The rows are written to a hidden folder below the table (``_carryover_loads/<id>``, which readers
pass over) and, once they are all there, their files are moved into the table, partitions added.

Repeating a load therefore

* adds nothing if it is ``done`` (and fails if it is offered other rows under the same id);
* moves what is left if it died while ``staged``: every file is moved once, whoever moves it;
* starts afresh if it died before that, after removing what it had written.

Moving is a rename of files, one by one, from the driver: cheap where a rename is; on object stores it
copies the load once more.  Rows of a load become visible file by file, as with any append of files.
Two runs of one load id at the same time are not kept apart; different ids are.
For tables of the session catalog; V2 catalogs commit an append as one snapshot of their own.
"""

from __future__ import annotations

import hashlib
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import quote_ident, quote_ref, split_ref, sql_col, sql_string
from .transforms import prepare_for_write
from .validate import combine, fingerprint, widens
from .versions import _catalog_texts, _fs, _partition_folders, _spec, delete_folder
from .write import TableInfo, _observed, catalog_of, describe_table, namespace_of, table_exists

LEDGER = "carryover_loads"
STATES = ("begun", "staged", "done")
_COLUMNS = "load_id string, target string, state string, rows bigint, hash_sum string, noted_at bigint"


@dataclass
class Appended:
    load_id: str
    rows: int
    status: str  # added, already, recovered


def ledger_of(table: str) -> str:
    space = namespace_of(table)
    return f"{space}.{quote_ident(LEDGER)}" if space else quote_ident(LEDGER)


def _note(spark: SparkSession, table: str, load_id: str, state: str, rows: int | None = None, hash_sum: int | None = None) -> None:
    row = (load_id, _target(table), state, rows, None if hash_sum is None else str(hash_sum), time.time_ns())
    spark.createDataFrame([row], _COLUMNS).coalesce(1).write.mode("append").format("parquet").saveAsTable(ledger_of(table))


def _target(table: str) -> str:
    return split_ref(table)[-1].lower()


def load_state(spark: SparkSession, table: str, load_id: str):
    """The furthest state noted for a load (a row), or ``None``."""
    ledger = ledger_of(table)
    if not spark.catalog.tableExists(ledger):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {ledger} ({_COLUMNS}) USING parquet")
        return None
    spark.catalog.refreshTable(ledger)
    rows = spark.table(ledger).where((F.col("load_id") == load_id) & (F.col("target") == _target(table))).collect()
    return max(rows, key=lambda r: (STATES.index(r["state"]), r["noted_at"]), default=None)


def _as_target(df: DataFrame, table: str) -> DataFrame:
    """The rows with the table's columns, in its order and types; only lossless widening is done."""
    have = {f.name.lower(): f for f in df.schema.fields}
    fields = df.sparkSession.table(quote_ref(table)).schema.fields
    if set(have) != {f.name.lower() for f in fields}:
        raise ValueError(f"columns {sorted(have)} do not match those of {table}")
    out = []
    for f in fields:
        own = have[f.name.lower()]
        if own.dataType != f.dataType and not widens(own.dataType, f.dataType):
            raise ValueError(f"column {f.name}: {own.dataType.simpleString()} does not fit {f.dataType.simpleString()}")
        out.append(sql_col(own.name).cast(f.dataType).alias(f.name))
    return df.select(*out)


def append_once(df: DataFrame, table: str, load_id: str, *, verify_source: bool = True) -> Appended:
    """Append the rows of ``df`` under ``load_id``, unless that was done before.

    ``verify_source=False`` takes the caller's word that a finished load has the same rows
    (no scan of the source)."""
    spark = df.sparkSession
    if catalog_of(spark, table) != "spark_catalog":
        raise ValueError("append_once is for tables of the session catalog")
    if not table_exists(spark, table):
        raise ValueError(f"append target {table} does not exist")
    info = describe_table(spark, table)
    if info.partition_columns is None or info.location is None:
        raise ValueError(f"{table} has no files of its own to append to")
    parts = info.partition_columns
    rows = _as_target(df, table)
    noted = load_state(spark, table, load_id)
    stage = f"{info.location.rstrip('/')}/_{LEDGER}/{hashlib.sha256(load_id.encode()).hexdigest()[:16]}"
    if noted is not None and noted["state"] == "done":
        if verify_source:
            now = fingerprint(rows)
            if (now["rows"], str(now["hash_sum"])) != (noted["rows"], noted["hash_sum"]):
                raise ValueError(f"load {load_id!r} was finished with other rows")
        return Appended(load_id, noted["rows"], "already")
    recovered = noted is not None
    if noted is None or noted["state"] == "begun":
        delete_folder(spark, stage)
        _note(spark, table, load_id, "begun")
        observed, obs = _observed(prepare_for_write(rows, partition_by=parts), True)
        writer = observed.write.format(info.provider or "parquet")
        (writer.partitionBy(*parts) if parts else writer).save(stage)
        found = combine(obs.get)
        _note(spark, table, load_id, "staged", int(found["rows"]), int(found["hash_sum"]))
        n, hash_sum = int(found["rows"]), int(found["hash_sum"])
    else:
        n, hash_sum = noted["rows"], int(noted["hash_sum"])
    publish(spark, table, info, stage)
    _note(spark, table, load_id, "done", n, hash_sum)
    return Appended(load_id, n, "recovered" if recovered else "added")


def publish(spark: SparkSession, table: str, info: TableInfo, stage: str) -> None:
    """Move the files of a staged load into the table; what was moved before is no longer there to move."""
    ref, parts = quote_ref(table), list(info.partition_columns or ())
    fs, root = _fs(spark, stage)
    if fs.exists(root):
        places = _partition_places(spark, ref, parts)
        new = []
        for folder, *texts in _partition_folders(spark, stage, parts):
            to = places.get(tuple(texts)) if parts else info.location.rstrip("/")
            if to is None:
                to = info.location.rstrip("/") + folder[len(_qualified(spark, stage)) :]
                new.append((tuple(texts), to))
            _move_files(spark, folder, to)
        for i in range(0, len(new), 200):
            what = " ".join(f"PARTITION ({_spec(parts, t)}) LOCATION {sql_string(to)}" for t, to in new[i : i + 200])
            spark.sql(f"ALTER TABLE {ref} ADD IF NOT EXISTS {what}")
        delete_folder(spark, stage)
    spark.catalog.refreshTable(ref)


def _qualified(spark: SparkSession, path: str) -> str:
    fs, hadoop = _fs(spark, path)
    return fs.makeQualified(hadoop).toString()


def _partition_places(spark: SparkSession, ref: str, parts: list[str]) -> dict[tuple, str]:
    """Folders of the partitions the catalog knows."""
    out = {}
    for row in spark.sql(f"SHOW PARTITIONS {ref}").collect() if parts else []:
        texts = _catalog_texts(row[0], parts)
        details = spark.sql(f"DESCRIBE TABLE EXTENDED {ref} PARTITION ({_spec(parts, texts)})").collect()
        names = [(r[0] or "").strip() for r in details]
        at = names.index("Location", names.index("# Detailed Partition Information"))  # the table's own stands below
        out[texts] = details[at][1].strip().rstrip("/")
    return out


def _move_files(spark: SparkSession, folder: str, to: str) -> None:
    fs, hadoop = _fs(spark, folder)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    fs.mkdirs(target)
    for status in fs.listStatus(hadoop):
        name = status.getPath().getName()
        if status.isFile() and not name.startswith(("_", ".")):
            if not fs.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(target, name)):
                raise RuntimeError(f"could not move {name} from {folder} to {to}")
