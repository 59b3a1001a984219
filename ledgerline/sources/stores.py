"""Keyed tables that outlive the process: data folders written first, a manifest that names them written last."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.operators.relational import newest


class Files:
    """The file system of a path, as the cluster's own client sees it."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm = spark._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, file: str) -> str:
        stream = self.fs.open(self.path(file))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, file: str, text: str) -> None:
        """Write aside, then rename: the file appears whole or not at all, and never replaces another."""
        aside = self.path(f"{file}.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(aside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.fs.exists(self.path(file)) or not self.fs.rename(aside, self.path(file)):
            self.fs.delete(aside, False)
            raise RuntimeError(f"{file} exists: another writer was first")


class KeyedStore:
    """The newest row of each key, kept in partitions under ``path``.

    A merge writes the batch's newest rows into a new folder, split by partition, and then a manifest that adds them to
    the partitions they touch; other partitions are not read or written. Without the manifest the folder does not
    count, so a job that dies in between leaves the version before. A partition with more than ``most_pieces`` pieces
    is compacted within the merge: only its own pieces are read and written again. The manifest also holds the schema,
    the keys and the last batch id of each source, so another process can open the store by its path, and a batch that
    is replayed changes nothing.

    ``order`` says which row of a key is newest; ``part`` is a SQL expression over a row that never changes for a key.
    One writer at a time: of two that start from one version, the second fails and its rows do not count.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), order: Sequence[str] = (), part: str = "0", most_pieces: int = 8) -> None:
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark, path)
        fresh = {"version": 0, "keys": list(keys), "order": list(order), "part": part, "schema": None, "parts": {}, "batches": {}}
        self.first, self.most_pieces = fresh, most_pieces
        if keys and (known := self.manifest())["version"] and [known[k] for k in ("keys", "order", "part")] != [fresh[k] for k in ("keys", "order", "part")]:
            raise ValueError(f"{path} holds a store with other keys, order or partitions")
        if not keys and not self.manifest()["keys"]:
            raise FileNotFoundError(f"no store at {path}")

    def manifest(self, version: int | None = None) -> dict:
        """The newest manifest, or that of ``version``."""
        folder = f"{self.path}/manifest"
        found = [n for n in self.files.names(folder) if n.endswith(".json")]
        if version is not None:
            found = [n for n in found if int(n[:-5]) == version]
        return json.loads(self.files.read(f"{folder}/{found[-1]}")) if found else dict(self.first)

    def _rows(self, manifest: dict, pieces: Sequence[str]) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        if not pieces:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{p}" for p in pieces])
        return newest(rows, manifest["keys"], manifest["order"])

    def read(self, version: int | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """The rows of the newest version, or of an earlier one; of some partitions, or of all."""
        manifest = self.manifest(version)
        if manifest["schema"] is None:
            raise FileNotFoundError(f"{self.path} has no rows yet")
        wanted = manifest["parts"] if parts is None else {p: manifest["parts"].get(p, []) for p in parts}
        return self._rows(manifest, [piece for pieces in wanted.values() for piece in pieces])

    def _write(self, manifest: dict, rows: DataFrame) -> dict[str, str]:
        """One new folder; the piece that each partition got in it."""
        name = uuid.uuid4().hex
        rows.withColumn("_part", F.expr(manifest["part"]).cast("string")).write.partitionBy("_part").parquet(f"{self.path}/data/{name}")
        found = [n for n in self.files.names(f"{self.path}/data/{name}") if n.startswith("_part=")]
        return {unquote(n[len("_part=") :]): f"{name}/{n}" for n in found}

    def merge(self, batch: DataFrame, batch_id: int | None = None, source: str = "batches", before_commit: Callable[[], None] = lambda: None) -> bool:
        """Add a batch; False if this source's batch has been added before. ``before_commit`` runs ahead of the manifest."""
        now = self.manifest()
        if batch_id is not None and batch_id <= now["batches"].get(source, -1):
            return False
        schema = batch.schema.jsonValue()
        if now["schema"] is not None and [(f["name"], f["type"]) for f in now["schema"]["fields"]] != [(f["name"], f["type"]) for f in schema["fields"]]:
            raise ValueError("the batch has other columns than the store")
        after = now | {"version": now["version"] + 1, "schema": now["schema"] or schema, "parts": dict(now["parts"]), "batches": dict(now["batches"])}
        for part, piece in self._write(now, newest(batch, now["keys"], now["order"]).select(*batch.columns)).items():
            after["parts"][part] = [*after["parts"].get(part, []), piece]
        if batch_id is not None:
            after["batches"][source] = batch_id
        crowded = [p for p, pieces in after["parts"].items() if len(pieces) > self.most_pieces]
        if crowded:
            rows = self._rows(after, [piece for p in crowded for piece in after["parts"][p]])
            after["parts"] |= {p: [piece] for p, piece in self._write(after, rows).items()}
        before_commit()
        self.files.publish(f"{self.path}/manifest/{after['version']:020d}.json", json.dumps(after))
        return True
