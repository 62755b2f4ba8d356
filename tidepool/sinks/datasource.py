"""Sinks with commit and abort per batch, as Spark Python data sources (SNK-2, SNK-5, UDF-11).

``target_format`` turns a *target* into a format for ``df.write`` and
``sdf.writeStream``. Tasks stage rows at the target and return tokens; when all
tasks of a batch have succeeded, the driver commits the tokens under the batch's
number, else it aborts them. A target that remembers committed batch numbers
takes a replayed batch only once, which makes the stream's output exactly-once.

``FileTarget`` keeps JSON lines in a folder that driver and executors share.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage


class Target:
    """UDF-11: where rows go. Instances are pickled to the tasks, so connections
    are opened inside the methods."""

    def stage(self, rows: Iterator[dict]) -> Any:
        """On an executor: put rows where no reader sees them yet; returns a picklable token."""
        raise NotImplementedError

    def commit(self, batch: str, tokens: list) -> None:
        """On the driver: show what the tokens name, unless ``batch`` is committed already."""
        raise NotImplementedError

    def abort(self, tokens: list) -> None:
        """On the driver: forget what the tokens name."""
        raise NotImplementedError


@dataclass
class _Token(WriterCommitMessage):
    token: Any


class _Writer:
    def __init__(self, target: Target, batch: str):
        self.target, self.batch = target, batch

    def write(self, iterator):
        return _Token(self.target.stage(r.asDict(recursive=True) for r in iterator))

    def _commit(self, messages, batch: str) -> None:
        self.target.commit(batch, [m.token for m in messages if m is not None])

    def _abort(self, messages) -> None:
        self.target.abort([m.token for m in messages if m is not None])


class _BatchWriter(_Writer, DataSourceWriter):
    def commit(self, messages):
        self._commit(messages, self.batch)

    def abort(self, messages):
        self._abort(messages)


class _StreamWriter(_Writer, DataSourceStreamWriter):
    def commit(self, messages, batchId):
        self._commit(messages, f"{self.batch}{batchId:09d}")

    def abort(self, messages, batchId):
        self._abort(messages)


def target_format(spark: SparkSession, name: str, target: Target) -> str:
    """Register ``target`` as format ``name``. Options: ``batch`` names a batch
    write (default: a new name each time); a stream's batches are numbered, after
    ``prefix`` if several streams share the target."""
    class TargetSource(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return "value string"

        def writer(self, schema, overwrite):
            return _BatchWriter(target, self.options.get("batch") or f"w{uuid.uuid4().hex}")

        def streamWriter(self, schema, overwrite):
            return _StreamWriter(target, self.options.get("prefix", "s"))

    spark.dataSource.register(TargetSource)
    return name


class FileTarget(Target):
    """Rows as JSON lines in files of a shared folder. A batch is committed by
    creating its manifest, the list of its files: one atomic step. Files that no
    manifest lists, of failed tasks or of replayed batches, are never read."""

    def __init__(self, path: str):
        path = path.removeprefix("file://")
        if "://" in path:
            raise ValueError("a folder that driver and executors see as a file system")
        self.path = path

    def stage(self, rows):
        os.makedirs(f"{self.path}/rows", exist_ok=True)
        name = f"{uuid.uuid4().hex}.jsonl"
        with open(f"{self.path}/rows/{name}", "w", encoding="utf-8") as f:
            for r in rows:
                f.write(json.dumps(r, ensure_ascii=False, default=str) + "\n")
            f.flush()
            os.fsync(f.fileno())
        return name

    def commit(self, batch, tokens):
        os.makedirs(f"{self.path}/batches", exist_ok=True)
        part = f"{self.path}/batches/.{uuid.uuid4().hex}"
        with open(part, "w", encoding="utf-8") as f:
            json.dump(tokens, f)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(part, f"{self.path}/batches/{batch}.json")  # fails where the batch is there: the first one counts
        except FileExistsError:
            self.abort(tokens)
        finally:
            os.unlink(part)

    def abort(self, tokens):
        for name in tokens:
            try:
                os.unlink(f"{self.path}/rows/{name}")
            except FileNotFoundError:
                pass

    def files(self) -> list[str]:
        """Files of all committed batches."""
        at = f"{self.path}/batches"
        names = sorted(n for n in os.listdir(at) if n.endswith(".json")) if os.path.isdir(at) else []
        return [f"{self.path}/rows/{f}" for n in names for f in json.load(open(f"{at}/{n}", encoding="utf-8"))]

    def read(self, spark: SparkSession, schema: str) -> DataFrame:
        files = self.files()
        return spark.read.schema(schema).json(files) if files else spark.createDataFrame([], schema)
