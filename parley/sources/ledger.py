"""Tables that grow batch by batch and are folded while they are read.

Rows lie in ``data/src=<source>/<by>=<slot>``: one source per stream and batch, one slot per day, hour
or key bucket. ``manifest/<version>.json`` says which sources count for each slot. A version is a new
file, so whoever read the table under an older one keeps seeing exactly that: a batch or a fold shows
as a whole or not at all. The manifest grows with slots and unfolded batches, never with rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from parley.session import shuffles_freed, stages_deleted
from parley.sources.files import write_batches

#: Slots that a caller may name at a time.
MOST_SLOTS = 10_000


class Ledger:
    """A table at ``root`` with rows of ``schema``, kept by the string column ``by``."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType | str, by: str) -> None:
        if isinstance(schema, str):
            schema = StructType.fromDDL(schema)
        self.spark, self.root, self.by = spark, root.rstrip("/"), by
        kept = [f for f in schema.fields if f.name != by]
        self.schema = StructType(kept).add(by, StringType())

    # -- manifest -------------------------------------------------------------------------------

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self, folder: str) -> list[str]:
        fs, path = self._path(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _versions(self) -> list[int]:
        names = self._names("manifest")
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def _content(self, version: int) -> dict | None:
        """A manifest, or None for one whose writer was lost halfway."""
        fs, path = self._path(f"manifest/{version:012d}.json")
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def _newest(self, versions: list[int]) -> dict:
        for version in reversed(versions):
            if content := self._content(version):
                return content
        return {"version": 0, "landed": {}, "slots": {}}

    def manifest(self) -> dict:
        """{version, landed: {run: last batch}, slots: {slot: sources}} as of now."""
        return self._newest(self._versions())

    def _commit(self, change: Callable[[dict], None]) -> None:
        """Writes a new manifest; if another writer was first, the change is made to theirs."""
        while True:
            versions = self._versions()
            content = self._newest(versions)
            change(content)
            content["version"] = versions[-1] + 1 if versions else 1
            fs, path = self._path(f"manifest/{content['version']:012d}.json")
            try:
                stream = fs.create(path, False)
            except Py4JJavaError as error:
                if "AlreadyExists" not in str(error.java_exception):
                    raise
                continue
            stream.write(json.dumps(content).encode())
            stream.close()
            return

    # -- rows -----------------------------------------------------------------------------------

    def _write(self, df: DataFrame, source: str) -> list[str]:
        """Writes one source; the names of its slots."""
        kinds = dict(df.dtypes)
        rows = df.select(
            *[
                F.col(f.name) if kinds[f.name] == f.dataType.simpleString() else F.col(f.name).cast(f.dataType)
                for f in self.schema.fields
            ]
        )
        rows = rows.hint("rebalance", F.col(self.by))
        with shuffles_freed(df.sparkSession):
            rows.write.mode("overwrite").partitionBy(self.by).parquet(f"{self.root}/data/src={source}")
        mark = f"{self.by}="
        return [n.removeprefix(mark) for n in self._names(f"data/src={source}") if n.startswith(mark)]

    def add(self, df: DataFrame, run: str, batch: int) -> bool:
        """Adds a batch of a run once: one that is in already is left as it is (False).

        Rows that a lost attempt left behind are in no manifest and are written over.
        """
        if self.manifest()["landed"].get(run, -1) >= batch:
            return False
        source = f"{run}-{batch}"
        slots = self._write(df, source)

        def change(content: dict) -> None:
            for slot in slots:
                content["slots"].setdefault(slot, []).append(source)
            content["landed"][run] = batch

        self._commit(change)
        return True

    def _rows(self, slots: dict[str, list[str]]) -> DataFrame:
        base = f"{self.root}/data"
        paths = [f"{base}/src={source}/{self.by}={slot}" for slot, held in slots.items() for source in held]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        # the folder's name as a string, whatever it looks like
        found = self.spark.read.schema(self.schema).option("basePath", base).parquet(*paths)
        return found.select(*self.schema.names)

    def read(self, slots: Iterable[str] | None = None) -> DataFrame:
        """The table as of now, or some slots of it: no other slot's folder is listed or opened."""
        held = self.manifest()["slots"]
        if slots is not None:
            held = {s: held[s] for s in sorted(set(map(str, slots))) if s in held}
        return self._rows(held)

    def slots_of(self, df: DataFrame, column: str | None = None) -> list[str]:
        """The slots named in a column, for ``read``; more than MOST_SLOTS are an error."""
        names = df.select(F.col(column or self.by).cast("string")).distinct().limit(MOST_SLOTS + 1).collect()
        if len(names) > MOST_SLOTS:
            raise ValueError(f"more than {MOST_SLOTS} slots at a time; use larger ones")
        return [r[0] for r in names if r[0] is not None]

    def fold(
        self,
        slots: Iterable[str] | None = None,
        rewrite: Callable[[DataFrame], DataFrame] | None = None,
        least: int = 2,
    ) -> list[str]:
        """Makes one source of each slot's several (``least`` or more); the folded slots.

        ``rewrite`` may merge rows, slot by slot. Batches that arrive meanwhile stay beside the new
        source, and readers of older versions keep the old folders until ``vacuum``.
        """
        held = self.manifest()["slots"]
        chosen = held if slots is None else [s for s in map(str, slots) if s in held]
        old = {s: list(held[s]) for s in chosen if len(held[s]) >= least}
        if not old:
            return []
        rows = self._rows(old)
        source = f"fold-{uuid.uuid4().hex}"
        written = self._write(rewrite(rows) if rewrite else rows, source)

        def change(content: dict) -> None:
            for slot, sources in old.items():
                now = [s for s in content["slots"].get(slot, []) if s not in sources]
                if slot in written:
                    now.insert(0, source)
                content["slots"][slot] = now
                if not now:
                    del content["slots"][slot]

        self._commit(change)
        return sorted(old)

    def vacuum(self, keep: int = 10) -> int:
        """Deletes all but the newest ``keep`` manifests and the folders that only those name."""
        versions = self._versions()
        kept = [c for c in map(self._content, versions[-keep:]) if c]
        used = {(slot, s) for c in kept for slot, held in c["slots"].items() for s in held}
        gone = 0
        for version in versions[:-keep]:
            old = self._content(version) or {"slots": {}}
            for slot, source in {(slot, s) for slot, held in old["slots"].items() for s in held} - used:
                fs, path = self._path(f"data/src={source}/{self.by}={slot}")
                gone += bool(fs.delete(path, True))
            fs, path = self._path(f"manifest/{version:012d}.json")
            fs.delete(path, False)
        return gone


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that a checkpoint belongs to: the same after a restart, another for a
    fresh checkpoint in the same place."""
    line = spark.read.text(f"{checkpoint}/metadata").first()[0]
    return json.loads(line)["id"].replace("-", "")


def start_landing(
    stream: DataFrame,
    land: Callable[[DataFrame, str, int], None],
    checkpoint: str,
    every: str | None = "5 seconds",
) -> StreamingQuery:
    """Hand each batch to ``land`` with its run's id and its number; what it stages goes when it returns."""
    spark, known = stream.sparkSession, []

    def each_batch(batch: DataFrame, number: int) -> None:
        if not known:
            known.append(run_of(spark, checkpoint))
        with stages_deleted(spark):
            land(batch, known[0], number)

    return write_batches(stream, each_batch, checkpoint, every)
