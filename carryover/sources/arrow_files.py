"""Arrow IPC files, which Spark cannot read, through the Python Data Source API.

:class:`ArrowSource` is a source like the others (registry kind ``arrow``).
Behind it stands a data source ``arrow_files``:

* A file of ``split_bytes`` or more is read by several tasks, each a share of its
  record batches.  Splits follow from the listing (names and sizes); only one
  footer, for the schema, is opened before the tasks run.
* Tasks hand record batches to Spark as they are (no row objects).  ``columns``
  limits what is read from the file (the API has no column pruning of its own).
* Simple filters that Spark pushes (comparisons, ``IN``, NULL tests on top-level columns)
  are applied to the batches before rows leave the Python process, if
  ``spark.sql.python.filterPushdown.enabled`` is set (:class:`ArrowSource` asks for it in
  its session settings).
* Writing (``df.write.format("arrow_files")``) makes one file a task in a hidden folder;
  the commit moves the files of the committed attempts, so lost executors and
  failed jobs leave no rows.

Paths are local (shared) folders or what ``pyarrow.fs`` opens by its URI (``s3://``, ``gs://``).
All files must have the columns of the first by name; a file that lacks
one, or holds another type, fails with its name.  Hidden files and folders count for nothing, folders
are read whole (``key=value`` names are no columns).  Files without batches have no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions.names import path_stem, path_table_name, target_table_name

FORMAT = "arrow_files"
SPLIT_BYTES = 128 * 1024 * 1024


def register_arrow_files(spark: SparkSession) -> None:
    """Make the format ``arrow_files`` known to the session."""
    spark.dataSource.register(_data_source())


def _data_source() -> type:
    # Defined in a function, so that workers get the classes by value and need no copy of this package.
    import re
    import uuid

    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.fs as pafs
    import pyarrow.ipc as ipc
    from pyspark.sql import datasource as ds
    from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

    def opened(path: str):
        if re.match("^[A-Za-z][A-Za-z0-9+.-]*:", path) and not path.startswith("file:"):
            return pafs.FileSystem.from_uri(re.sub("^s3a:", "s3:", path))
        return pafs.LocalFileSystem(), re.sub("^file:/+", "/", path)

    def listing(path: str) -> list:
        store, where = opened(path)
        info = store.get_file_info(where)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(f"no such path: {path}")
        if info.type == pafs.FileType.File:
            return [info]
        below = store.get_file_info(pafs.FileSelector(where, recursive=True))
        base = where.rstrip("/") + "/"

        def shown(name: str) -> bool:
            return not any(part.startswith(("_", ".")) for part in name[len(base) :].split("/"))

        return sorted((f for f in below if f.type == pafs.FileType.File and f.size and shown(f.path)), key=lambda f: f.path)

    class Share(ds.InputPartition):
        """Every ``of``-th record batch of a file, from ``at`` on."""

        def __init__(self, path: str, at: int, of: int):
            super().__init__(path)
            self.path, self.at, self.of = path, at, of

    def test_of(f):
        """A pushed filter as a function of a record batch, or None if Spark has to apply it."""
        if isinstance(f, ds.Not):
            inner = test_of(f.child)
            return inner and (lambda b: pc.invert(inner(b)))
        column = getattr(f, "attribute", None)
        if not column or len(column) != 1:
            return None
        name = column[0]
        if isinstance(f, ds.IsNull):
            return lambda b: pc.is_null(b.column(name))
        if isinstance(f, ds.IsNotNull):
            return lambda b: pc.is_valid(b.column(name))
        compare = {
            ds.EqualTo: pc.equal,
            ds.GreaterThan: pc.greater,
            ds.GreaterThanOrEqual: pc.greater_equal,
            ds.LessThan: pc.less,
            ds.LessThanOrEqual: pc.less_equal,
        }.get(type(f))
        value = getattr(f, "value", None)
        if isinstance(value, float) or (isinstance(f, ds.In) and any(isinstance(v, float) for v in value)):
            return None  # NaN and -0.0 compare in Spark's own way
        if compare and isinstance(value, (bool, int, str)):
            return lambda b: compare(b.column(name), pa.scalar(value))
        if isinstance(f, ds.In) and all(isinstance(v, (bool, int, str)) for v in value):
            return lambda b: pc.if_else(
                pc.is_null(b.column(name)), None, pc.is_in(b.column(name), pa.array(list(value)).cast(b.column(name).type))
            )
        return None

    class Reader(ds.DataSourceReader):
        def __init__(self, schema, path: str, split_bytes: int):
            self.schema, self.path, self.split_bytes = schema, path, split_bytes
            self.pushed: list = []

        def partitions(self):
            shares = []
            for info in listing(self.path):
                of = max(1, -(-info.size // self.split_bytes))
                shares += [Share(info.path, at, of) for at in range(of)]
            return shares or [Share("", 0, 1)]

        def read(self, partition):
            if not partition.path:
                return
            tests = [test_of(f) for f in self.pushed]
            names = [f.name for f in self.schema.fields]
            wanted = to_arrow_schema(self.schema)
            store, _ = opened(self.path)
            with store.open_input_file(partition.path) as handle:
                found = ipc.open_file(handle).schema
                missing = [n for n in names if n not in found.names]
                if missing:
                    raise ValueError(f"{partition.path} lacks {', '.join(missing)}")
                fields = ipc.IpcReadOptions(included_fields=[found.get_field_index(n) for n in names])
                file = ipc.open_file(handle, options=fields)
                for i in range(partition.at, file.num_record_batches, partition.of):
                    batch = file.get_batch(i).select(names)
                    for test in tests:
                        batch = batch.filter(test(batch))  # NULL is not true
                    if [c.type for c in batch.columns] != wanted.types:
                        try:
                            batch = pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(batch.columns, wanted.types)], names)
                        except pa.ArrowInvalid as exc:
                            raise ValueError(f"{partition.path}: {exc}") from None
                    if batch.num_rows:
                        yield batch

    class PushingReader(Reader):
        def pushFilters(self, filters):  # noqa: N802 - Spark's name
            floats = {f.name for f in self.schema.fields if f.dataType.typeName() in ("float", "double")}
            for f in filters:
                inner = f.child if isinstance(f, ds.Not) else f
                floating = getattr(inner, "attribute", ("",))[0] in floats
                if floating and not isinstance(inner, (ds.IsNull, ds.IsNotNull)) or test_of(f) is None:
                    yield f
                else:
                    self.pushed.append(f)

    class Part(ds.WriterCommitMessage):
        def __init__(self, path: str):
            self.path = path

    class Writer(ds.DataSourceArrowWriter):
        def __init__(self, schema, path: str, overwrite: bool):
            self.path, self.overwrite, self.schema = path.rstrip("/"), overwrite, schema
            self.stage = f"{self.path}/_stage-{uuid.uuid4().hex}"
            store, where = opened(self.stage)
            store.create_dir(where, recursive=True)

        def write(self, iterator):
            store, where = opened(f"{self.stage}/part-{uuid.uuid4().hex}.arrow")
            out = None
            with store.open_output_stream(where) as sink:
                for batch in iterator:
                    out = out or ipc.new_file(sink, batch.schema)
                    out.write_batch(batch)
                if out is None:
                    out = ipc.new_file(sink, to_arrow_schema(self.schema))
                out.close()
            return Part(where)

        def commit(self, messages):
            store, target = opened(self.path)
            old = [f.path for f in listing(self.path)] if self.overwrite else []
            for m in messages:
                if m is not None:
                    store.move(m.path, f"{target}/{m.path.rsplit('/', 1)[1]}")
            for path in old:
                store.delete_file(path)
            self._clear()

        def abort(self, messages):
            self._clear()

        def _clear(self) -> None:
            store, where = opened(self.stage)
            store.delete_dir(where)

    class ArrowFiles(ds.DataSource):
        @classmethod
        def name(cls) -> str:
            return "arrow_files"

        def _columns(self) -> list[str]:
            return [c for c in self.options.get("columns", "").split("\x1f") if c]

        def schema(self):
            files = listing(self.options["path"])
            if not files:
                raise ValueError(f"no Arrow files under {self.options['path']}")
            store, _ = opened(self.options["path"])
            with store.open_input_file(files[0].path) as handle:
                found = ipc.open_file(handle).schema
            keep = self._columns() or found.names
            return from_arrow_schema(pa.schema([found.field(n) for n in keep]), prefer_timestamp_ntz=True)

        def reader(self, schema):
            kind = PushingReader if self.options.get("push") == "true" else Reader  # Spark refuses the one where it is off
            return kind(schema, self.options["path"], int(self.options.get("split_bytes", 128 * 1024 * 1024)))

        def writer(self, schema, overwrite):
            return Writer(schema, self.options["path"], overwrite)

    return ArrowFiles


@dataclass(frozen=True)
class ArrowSource:
    """Reads Arrow IPC files or folders of them; ``columns`` reads only those."""

    columns: Sequence[str] = ()
    split_bytes: int = SPLIT_BYTES
    kind: str = "arrow"

    def session_settings(self) -> dict[str, str]:
        return {"spark.sql.python.filterPushdown.enabled": "true"}

    def resolve(self, ref: str) -> str:
        return path_stem(ref)

    def target_name(self, ref: str) -> str:
        name = path_table_name(ref)
        return target_table_name(name[: -len(".arrow")] if name.endswith(".arrow") else name)

    def read(self, spark: SparkSession, ref: str) -> DataFrame:
        register_arrow_files(spark)
        reader = spark.read.format(FORMAT).option("split_bytes", str(self.split_bytes))
        push = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
        return reader.option("columns", "\x1f".join(self.columns)).option("push", push).load(ref)
