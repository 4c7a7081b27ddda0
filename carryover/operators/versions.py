"""K2, K6: replacing a session-catalog table by pointing it at a new version of its files.

The new rows are written to a folder of their own beside the table's, named
``<table>__v_<8 hex>``; then the catalog is told, and the old folder goes.  Nothing is renamed,
so on an object store nothing is copied, and the name has a table at every moment:

* a table without partitions is switched by one ``SET LOCATION``;
* of a partitioned table, the location is set first (where partitions to come will lie),
  then each partition that both versions have is switched by a ``SET LOCATION`` of its own, new
  ones are added and vanished ones dropped, ``BATCH`` in a statement.  Until the last statement the
  table holds old partitions beside new ones, each whole.

A failure while writing leaves the table as it was.  A driver that dies later leaves the old folder, or
some partitions of the old version: repeat the replace, it starts from whatever the catalog says
(and removes every version the table itself left behind).  Rows may be read from the table being replaced.

The old folder is removed if it is the table's own: a managed table's, or a version made here.
Folders the table was registered over are left alone.  Queries that still read the old version fail, as with
any overwrite; ``keep_old=True`` leaves it until the next replace.
"""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from ..functions.names import quote_ident, quote_ref, split_ref, sql_string

BATCH = 200
_VERSION = r"__v_[0-9a-f]{8}"


def _spec(columns: Sequence[str], texts: Sequence[str | None]) -> str:
    return ", ".join(f"{quote_ident(c)} = {'null' if t is None else sql_string(t)}" for c, t in zip(columns, texts))


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop = _fs(spark, path)
    fs.delete(hadoop, True)


def own_versions(spark: SparkSession, home: str, name: str) -> list[str]:
    """Version folders of the table below its home folder."""
    fs, hadoop = _fs(spark, home)
    if not fs.exists(hadoop):
        return []
    wanted = re.compile(re.escape(name) + _VERSION)
    return [s.getPath().toString() for s in fs.listStatus(hadoop) if s.isDirectory() and wanted.fullmatch(s.getPath().getName())]


def can_point(df: DataFrame, info, table: str, partition_by: Sequence[str]) -> bool:
    """Whether the table's catalog entry fits the new rows: same columns, types and partitioning."""
    if info.location is None or info.partition_columns is None or tuple(partition_by) not in ((), info.partition_columns):
        return False

    def shape(fields) -> list[tuple[str, str]]:
        moved = [f for f in fields if f.name not in info.partition_columns]
        return [(f.name, f.dataType.simpleString()) for f in moved] + sorted((f.name, f.dataType.simpleString()) for f in fields if f.name in info.partition_columns)

    return shape(df.schema.fields) == shape(df.sparkSession.table(quote_ref(table)).schema.fields)


def point_to(df: DataFrame, table: str, info, write, *, keep_old: bool = False) -> None:
    """Replace ``table`` by the rows of ``df``.  ``write(df, path)`` writes them as Parquet (or the table's
    format) partitioned by ``info.partition_columns``."""
    spark = df.sparkSession
    ref, name = quote_ref(table), split_ref(table)[-1].lower()
    old = info.location.rstrip("/")
    home = old.rsplit("/", 1)[0]
    new = f"{home}/{name}__v_{uuid.uuid4().hex[:8]}"
    managed = _is_managed(spark, ref)
    parts = list(info.partition_columns)
    try:
        write(df, new)
    except Exception:
        delete_folder(spark, new)
        raise
    if parts:
        _switch_partitions(spark, ref, parts, new)
    else:
        spark.sql(f"ALTER TABLE {ref} SET LOCATION {sql_string(new)}")
    spark.catalog.refreshTable(ref)
    if not keep_old:
        gone = [v for v in own_versions(spark, home, name) if v.rsplit("/", 1)[1] != new.rsplit("/", 1)[1]]
        if managed and old.rsplit("/", 1)[1] not in {v.rsplit("/", 1)[1] for v in [*gone, new]}:
            gone.append(old)
        for folder in gone:
            try:
                delete_folder(spark, folder)
            except Exception as exc:  # noqa: BLE001 - the replace itself succeeded
                logging.getLogger(__name__).warning("replaced %s, but could not remove %s: %s", table, folder, exc)


def _is_managed(spark: SparkSession, ref: str) -> bool:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {ref}").collect()
    return any((r[0] or "").strip() == "Type" and (r[1] or "").strip().upper() == "MANAGED" for r in rows)


def _switch_partitions(spark: SparkSession, ref: str, parts: list[str], new: str) -> None:
    folder = {tuple(texts): path for path, *texts in _partition_folders(spark, new, parts)}
    had = {_catalog_texts(r[0], parts): r[0] for r in spark.sql(f"SHOW PARTITIONS {ref}").collect()}
    spark.sql(f"ALTER TABLE {ref} SET LOCATION {sql_string(new)}")
    for texts in sorted(folder.keys() & had.keys(), key=str):
        spark.sql(f"ALTER TABLE {ref} PARTITION ({_spec(parts, texts)}) SET LOCATION {sql_string(folder[texts])}")
    for verb, which in (("ADD IF NOT EXISTS", folder.keys() - had.keys()), ("DROP IF EXISTS", had.keys() - folder.keys())):
        every = sorted(which, key=str)
        for i in range(0, len(every), BATCH):
            if verb.startswith("ADD"):
                what = " ".join(f"PARTITION ({_spec(parts, t)}) LOCATION {sql_string(folder[t])}" for t in every[i : i + BATCH])
            else:
                what = ", ".join(f"PARTITION ({_spec(parts, t)})" for t in every[i : i + BATCH])
            spark.sql(f"ALTER TABLE {ref} {verb} {what}")


def _partition_folders(spark: SparkSession, root: str, parts: list[str]) -> list[tuple]:
    """``(folder, value, …)`` of every partition below ``root``, one listing a level."""
    level: list[tuple] = [(root,)]
    for column in parts:
        below = []
        for path, *texts in level:
            fs, hadoop = _fs(spark, path)
            for status in fs.listStatus(hadoop):
                leaf = status.getPath().getName()
                if status.isDirectory() and leaf.startswith(f"{column}="):
                    text = unquote(leaf.split("=", 1)[1])
                    below.append((status.getPath().toString(), *texts, None if text == "__HIVE_DEFAULT_PARTITION__" else text))
        level = below
    return level


def _catalog_texts(spec: str, parts: list[str]) -> tuple:
    """The values of a ``SHOW PARTITIONS`` row."""
    values = dict(p.split("=", 1) for p in spec.split("/"))
    texts = (unquote(values[c] if c in values else values[c.lower()]) for c in parts)
    return tuple(None if t == "__HIVE_DEFAULT_PARTITION__" else t for t in texts)
