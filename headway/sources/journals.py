"""``arrow_journal``: a Python data source over append-only Arrow IPC stream files.

One partition per journal file of a dataset and day.  A file is read batch by
batch; a damaged tail ends the file after its last whole batch, a damaged or
empty header yields nothing.  ``output`` selects what is read:

* ``rows`` - the batches under the given schema; columns that are missing are
  NULL, values that do not cast go to ``_rescued`` if the schema has it;
* ``status`` - one row per file: clean, repaired or skipped;
* ``schema`` - one row per field of each readable file.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

STATUS_SCHEMA = "path string, bytes bigint, status string, batches bigint, rows bigint"
FIELD_SCHEMA = "path string, name string, type string, nullable boolean"


def arrow_type_name(arrow_type) -> str:
    """Arrow's name of plain types; of others, the name of the Spark type they become."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import from_arrow_type

    name = str(arrow_type)
    if pa.types.is_nested(arrow_type) or pa.types.is_decimal(arrow_type) or pa.types.is_date(arrow_type) \
            or pa.types.is_binary(arrow_type) or pa.types.is_large_binary(arrow_type):
        try:
            return from_arrow_type(arrow_type).simpleString()
        except Exception:  # a type that Spark lacks keeps its own name
            return name
    return name


@dataclass
class JournalFile(InputPartition):
    path: str
    size: int


def day_folder(root: str, dataset: str, day: date) -> str:
    return f"{root.rstrip('/')}/{dataset}/year={day.year}/month={day.month:02d}/day={day.day:02d}"


def open_folder(path: str) -> tuple:
    """Arrow filesystem of a path or URI, and the path inside it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def list_journals(root: str, dataset: str, day: date) -> list[JournalFile]:
    """``journal_*.ipc`` files of one day by name; empty files count, no folder is empty."""
    return _journals_in(day_folder(root, dataset, day))


def list_archived(archive: str, dataset: str, day: date) -> list[JournalFile]:
    """Journals of a day that were archived after an earlier compaction."""
    return _journals_in(f"{archive.rstrip('/')}/{dataset}/date={day.isoformat()}")


def _journals_in(folder: str) -> list[JournalFile]:
    from pyarrow import fs

    filesystem, inner = open_folder(folder)
    found = filesystem.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    return sorted(
        (JournalFile(f"{folder}/{f.base_name}", f.size) for f in found
         if f.is_file and f.base_name.startswith("journal_") and f.base_name.endswith(".ipc")),
        key=lambda f: f.path)


def _batches(filesystem, path: str, outcome: dict) -> Iterator:
    """Whole batches of a file; ``outcome`` tells afterwards how reading ended."""
    import pyarrow as pa

    outcome.update(schema=None, clean=False)
    with filesystem.open_input_file(path) as stream:
        try:
            reader = pa.ipc.open_stream(stream)
        except pa.ArrowInvalid:
            return
        except OSError:
            _raise_unless_at_end(stream)
            return
        outcome["schema"] = reader.schema
        while True:
            try:
                batch = reader.read_next_batch()
            except StopIteration:
                outcome["clean"] = True
                return
            except pa.ArrowInvalid:
                return
            except OSError:
                _raise_unless_at_end(stream)
                return
            yield batch


def _raise_unless_at_end(stream) -> None:
    """Called for a failed read: a file that simply ends too early was read to its end.

    Anything else is a fault of the storage; the task fails and is tried again.
    """
    if stream.tell() < stream.size():
        raise


def _fit(column, wanted) -> tuple:
    """Column cast to the wanted type, and the text of values that do not cast."""
    import pyarrow as pa

    if column.type == wanted:
        return column, {}
    try:
        return column.cast(wanted), {}
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
        pass
    kept, lost = [], {}
    for i, value in enumerate(column.to_pylist()):
        try:
            kept.append(pa.scalar(value).cast(wanted).as_py() if value is not None else None)
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
            kept.append(None)
            lost[i] = str(value)
    return pa.array(kept, wanted), lost


class JournalReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema = schema
        self.root, self.dataset = options["path"], options["dataset"]
        self.day = date.fromisoformat(options["date"])
        self.output = options.get("output", "rows")
        self.archive = options.get("archive")

    def partitions(self) -> list[InputPartition]:
        archived = (list_archived(self.archive, self.dataset, self.day) if self.archive else [])
        return archived + list_journals(self.root, self.dataset, self.day)

    def read(self, partition: JournalFile) -> Iterator:
        if partition is None:  # no file that day
            return
        filesystem, inner = open_folder(partition.path)
        outcome: dict = {}
        batches = _batches(filesystem, inner, outcome)
        if self.output == "rows":
            yield from self._conform(batches)
        elif self.output == "schema":
            if next(batches, None) is not None:
                for field in outcome["schema"]:
                    yield (partition.path, field.name, arrow_type_name(field.type), field.nullable)
        else:
            count = rows = 0
            for batch in batches:
                count, rows = count + 1, rows + batch.num_rows
            status = "skipped" if not count else "clean" if outcome["clean"] else "repaired"
            yield (partition.path, partition.size, status, count, rows)

    def _conform(self, batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(self.schema)
        for batch in batches:
            columns, lost = [], {}
            for field in target:
                if field.name == "_rescued" or field.name not in batch.schema.names:
                    columns.append(pa.nulls(batch.num_rows, field.type))
                    continue
                column, failed = _fit(batch.column(field.name), field.type)
                columns.append(column)
                for row, text in failed.items():
                    lost.setdefault(row, []).append((field.name, text))
            if lost and "_rescued" in target.names:
                at = target.get_field_index("_rescued")
                columns[at] = pa.array([lost.get(i) for i in range(batch.num_rows)],
                                       target.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=target.names)


class ArrowJournal(DataSource):
    @classmethod
    def name(cls) -> str:
        return "arrow_journal"

    def schema(self) -> str:
        output = self.options.get("output", "rows")
        if output == "rows":
            raise ValueError("reading journal rows needs a schema")
        return STATUS_SCHEMA if output == "status" else FIELD_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return JournalReader(schema, self.options)


def _load(spark: SparkSession, root: str, dataset: str, day: date, output: str,
          archive: str | None, schema: StructType | None = None) -> DataFrame:
    spark.dataSource.register(ArrowJournal)
    reader = spark.read.format("arrow_journal").options(
        dataset=dataset, date=day.isoformat(), output=output)
    if archive is not None:
        reader = reader.option("archive", archive)
    return (reader.schema(schema) if schema is not None else reader).load(root)


def journal_status(spark: SparkSession, root: str, dataset: str, day: date,
                   archive: str | None = None) -> DataFrame:
    return _load(spark, root, dataset, day, "status", archive)


def journal_fields(spark: SparkSession, root: str, dataset: str, day: date,
                   archive: str | None = None) -> DataFrame:
    return _load(spark, root, dataset, day, "schema", archive)


def read_journals(spark: SparkSession, root: str, dataset: str, day: date, schema: StructType,
                  archive: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows, file_status)`` of one day; with ``archive`` its archived journals as well."""
    return (_load(spark, root, dataset, day, "rows", archive, schema),
            journal_status(spark, root, dataset, day, archive))
