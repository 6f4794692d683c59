"""Rows of a table by their place: the file they are in and their position there.

A stage that decides about whole texts decides on narrow rows that hold a place, and
writes what it decided as one small file for each file of the table.  One more pass
over the table then reads, for each batch, the list of its own file: no text is
shuffled or copied for it, at any size."""

from __future__ import annotations

import hashlib
import io
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from firmo.llm import files
from firmo.llm.common import column, free_name, shared_dir, written


def on_files(docs: DataFrame) -> DataFrame:
    """The table as a plain scan of files; any other table is written first."""
    plan = docs._jdf.queryExecution().analyzed().getClass().getSimpleName()
    return docs if plan == "LogicalRelation" else written(docs, "rows")


def placed(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """The table with two more columns, file and position, whose names come with it."""
    file, at = free_name(docs, "row_file"), free_name(docs, "row_at")
    about = docs.metadataColumn("_metadata")
    return docs.select("*", about["file_path"].alias(file), about["row_index"].alias(at)), file, at


def _name(folder: str, file: str) -> str:
    return f"{folder}/{hashlib.blake2b(file.encode(), digest_size=16).hexdigest()}.arrow"


def write_marks(marks: DataFrame) -> str:
    """Write (file, at, ...) rows, one small file for each file named; returns their
    folder.  A file's rows are at most as many as it has."""
    folder = shared_dir(marks.sparkSession, "marks")

    def run(batches):
        last, held = None, []

        def put() -> None:
            out = io.BytesIO()
            table = pa.Table.from_batches(held)
            with pa.ipc.new_stream(out, table.schema) as w:
                w.write_table(table)
            files.put(_name(folder, last), [out.getvalue()])

        for b in batches:
            names = column(b, "file").to_pylist()
            cut = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            for lo, hi in zip(cut, cut[1:], strict=False):
                if hi > lo:
                    if held and names[lo] != last:
                        put()
                        held = []
                    last = names[lo]
                    held.append(b.slice(lo, hi - lo).drop_columns(["file"]))
        if held:
            put()
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.string())], names=["file"])

    marks.repartition("file").sortWithinPartitions("file", "at").mapInArrow(run, "file string").count()
    return folder


def apply_marks(docs: DataFrame, folder: str, change: Callable[[pa.RecordBatch, list[dict | None]], pa.RecordBatch]) -> DataFrame:
    """The table, each batch passed through ``change`` with the marks of its rows (None:
    no mark), where it has any.  Columns and order stay."""
    with_place, file, at = placed(docs)
    names = docs.columns

    def run(batches):
        held: tuple[str | None, dict[int, dict]] = (None, {})
        for b in batches:
            where, place = column(b, file).to_pylist(), column(b, at).to_pylist()
            cut = [0, *(i for i in range(1, len(where)) if where[i] != where[i - 1]), len(where)]
            for lo, hi in zip(cut, cut[1:], strict=False):
                if hi == lo:
                    continue
                if where[lo] != held[0]:
                    uri = _name(folder, where[lo])
                    rows = pa.ipc.open_stream(files.read(uri)).read_all().to_pylist() if files.exists(uri) else []
                    held = (where[lo], {r["at"]: r for r in rows})
                part = pa.RecordBatch.from_arrays([column(b, c).slice(lo, hi - lo) for c in names], names=names)
                marks = [held[1].get(i) for i in place[lo:hi]] if held[1] else []
                yield change(part, marks) if any(m is not None for m in marks) else part

    return with_place.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in docs.dtypes))


def drop(batch: pa.RecordBatch, marks: list[dict | None]) -> pa.RecordBatch:
    """Marked rows go."""
    return batch.filter(pa.array([m is None for m in marks]))
