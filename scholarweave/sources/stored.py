"""Tables that grow by runs: what a run adds is there as a whole or not at all.

A run writes its rows to a folder of its own and then publishes them by one small manifest
named after the run. Readers follow the manifests and see nothing else, so a run that is
killed leaves rows that nobody reads, and repeating it adds its rows once. A run whose name
is already there adds nothing.

    <table>/rows/_run=<run>-<attempt>/...   rows of one attempt at a run
    <table>/runs/<run>.json                 number, folder and facts of a run that is done

A manifest is written beside its place and renamed to it, which no file system that Spark
writes to does by halves.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

_MANIFEST = "run string, number bigint, folder string, replaces array<string>, facts map<string,bigint>"


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files or folders matching a glob on any file system Spark can reach."""
    target, fs = _path(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(target) or []))


def _path(spark: SparkSession, name: str) -> tuple[Any, Any]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


@dataclass(frozen=True)
class Run:
    """A run that is done."""

    name: str
    number: int
    folder: str
    replaces: tuple[str, ...] = ()
    facts: dict[str, int] = field(default_factory=dict)


class StoredTable:
    """A table below a folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def runs(self) -> list[Run]:
        """The runs that are done, oldest first, without those that a later one replaces."""
        every = self._manifests()
        replaced = {name for run in every for name in run.replaces}
        return [run for run in every if run.name not in replaced]

    def _manifests(self) -> list[Run]:
        if not list_paths(self.spark, f"{self.path}/runs/*.json"):
            return []
        rows = self.spark.read.schema(_MANIFEST).json(f"{self.path}/runs/*.json").orderBy("number", "run").collect()
        return [Run(r.run, r.number, r.folder, tuple(r.replaces or ()), r.facts or {}) for r in rows]

    def read(self, schema: str | T.StructType | None = None) -> DataFrame | None:
        """Rows of all runs; before the first one an empty table, or None without a schema."""
        return self._read([self._folder("rows", run.folder) for run in self.runs()], schema)

    def read_run(self, run: Run, schema: str | T.StructType | None = None) -> DataFrame:
        return self._read([self._folder("rows", run.folder)], schema)

    def _read(self, folders: list[str], schema: str | T.StructType | None) -> DataFrame | None:
        if not folders:
            return None if schema is None else self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("basePath", f"{self.path}/rows")
        rows = (reader if schema is None else reader.schema(schema)).parquet(*folders)
        return rows.drop("_run", "_bucket")

    def _folder(self, kind: str, folder: str) -> str:
        return f"{self.path}/{kind}/_run={folder}"

    def append(self, df: DataFrame, run: str | None = None) -> bool:
        """Add the rows of a run; False if a run of this name has been added before."""
        run = _named(run)
        if any(run in (done.name, *done.replaces) for done in self._manifests()):
            return False
        folder = f"{run}-{uuid.uuid4().hex}"
        facts = self._write(df, folder)
        self._publish(Run(run, self._next(), folder, (), facts))
        return True

    def _write(self, df: DataFrame, folder: str) -> dict[str, int]:
        """Write the rows of an attempt, and return what readers have to know about them."""
        df.write.parquet(self._folder("rows", folder))
        return {}

    def _next(self) -> int:
        return max((run.number for run in self._manifests()), default=0) + 1

    def _publish(self, run: Run) -> None:
        text = json.dumps({
            "run": run.name, "number": run.number, "folder": run.folder, "replaces": list(run.replaces), "facts": run.facts,
        })
        draft, fs = _path(self.spark, f"{self.path}/runs/_{uuid.uuid4().hex}")
        final, _ = _path(self.spark, f"{self.path}/runs/{run.name}.json")
        out = fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        files = hadoop.FileContext.getFileContext(fs.getUri(), fs.getConf())
        # Without an option to overwrite; it fails if another attempt has come first.
        files.rename(draft, final, self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0))

    def compact(self, run: str | None = None) -> None:
        """Put the rows of all runs into one, in as many files as they need."""
        old = self.runs()
        rows = self.read()
        if len(old) > 1:
            run, replaced = _named(run), tuple(name for r in old for name in (r.name, *r.replaces))
            folder = f"{run}-{uuid.uuid4().hex}"
            facts = self._write(rows, folder)
            self._publish(Run(run, self._next(), folder, replaced, facts))

    def unread(self) -> list[str]:
        """Folders of attempts that were not published, or were replaced. A run that is still
        writing is among them, so they are to be removed only while none is."""
        known = {f"_run={run.folder}" for run in self.runs()}
        every = [p for kind in ("rows", "filters") for p in list_paths(self.spark, f"{self.path}/{kind}/_run=*")]
        return [p for p in every if p.rsplit("/", 1)[1] not in known]

    def discard_unread(self) -> None:
        for name in self.unread():
            path, fs = _path(self.spark, name)
            fs.delete(path, True)


def _named(run: str | None) -> str:
    if run is None:
        return f"run-{uuid.uuid4().hex}"
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", run):
        raise ValueError(f"not a name of a run: {run!r}")
    return run


# Bits of a bitmap that Spark's aggregate makes.
_PAGE = 1 << 15
_BITS_PER_KEY = 16


class KeyedTable(StoredTable):
    """A stored table that knows which of its parts may hold a key.

    Each run deals its rows out to buckets by a hash of the key and stores for each bucket a
    filter: bitmaps of another hash of its keys, of about 16 bits a key. To find out which
    keys are there, a batch looks at the filters of its own buckets and then reads the keys
    of those parts only that may hold some of them.

    ``buckets`` counts when a table is begun: as many as a run has files, by default as many
    as a shuffle has partitions.
    """

    def __init__(self, spark: SparkSession, path: str, key: str | Sequence[str], buckets: int | None = None) -> None:
        super().__init__(spark, path)
        self.key = [key] if isinstance(key, str) else list(key)
        begun = next((run.facts["buckets"] for run in self.runs()), None)
        self.buckets = begun or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _placed(self, keys: DataFrame, pages: int) -> DataFrame:
        """``keys`` with the bucket and the page and place in the bucket's filter."""
        slot = F.pmod(F.xxhash64(F.lit("filter"), *map(_quoted, self.key)), F.lit(pages * _PAGE))
        return keys.select(
            "*", self._bucket().alias("_bucket"), F.floor(slot / _PAGE).cast("int").alias("_page"), (slot % _PAGE).cast("int").alias("_place")
        )

    def _bucket(self):
        return F.pmod(F.xxhash64(*map(_quoted, self.key)), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame, folder: str) -> dict[str, int]:
        placed = df.withColumn("_bucket", self._bucket()).repartition(self.buckets, "_bucket")
        placed.write.partitionBy("_bucket").parquet(self._folder("rows", folder))
        written = self.spark.read.schema(self._key_schema(df)).parquet(self._folder("rows", folder))
        number = written.count()
        pages = 1
        while pages * _PAGE * self.buckets < _BITS_PER_KEY * number:
            pages *= 2
        filters = self._placed(written.select(*map(_quoted, self.key)), pages).groupBy("_bucket", "_page").agg(F.bitmap_construct_agg("_place").alias("bits"))
        filters.repartition("_bucket").write.partitionBy("_bucket").parquet(self._folder("filters", folder))
        return {"buckets": self.buckets, "pages": pages, "rows": number}

    def _key_schema(self, df: DataFrame) -> str:
        kinds = dict(df.dtypes)
        return ", ".join(f"{_quoted(c)} {kinds[c]}" for c in self.key)

    def parts_with(self, keys: DataFrame) -> list[str]:
        """Folders of the parts that may hold some of the keys. At most one for each run and bucket."""
        runs = [run for run in self.runs() if run.facts["rows"]]
        if not runs:
            return []
        touched = [r._bucket for r in keys.select(self._bucket().alias("_bucket")).distinct().collect()]
        found: list[str] = []
        for pages in sorted({run.facts["pages"] for run in runs}):
            # Filters of the batch's own buckets; runs and buckets are partitions.
            filters = (
                self.spark.read.option("basePath", f"{self.path}/filters").schema("_page int, bits binary, _run string, _bucket int")
                .parquet(*[self._folder("filters", run.folder) for run in runs if run.facts["pages"] == pages])
                .where(F.col("_bucket").isin(touched))
            )
            asked = self._placed(keys, pages).select("_bucket", "_page", "_place").distinct()
            byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("_place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            hit = F.getbit(byte, F.col("_place") % 8) == 1
            rows = asked.join(filters, ["_bucket", "_page"]).where(hit).select("_run", "_bucket").distinct().collect()
            found += [f"{self._folder('rows', r._run)}/_bucket={r._bucket}" for r in rows]
        return sorted(found)

    def known(self, keys: DataFrame) -> DataFrame | None:
        """The keys of all parts that may hold some of ``keys``, or None if there is none."""
        parts = self.parts_with(keys)
        return self._read(parts, self._key_schema(keys)) if parts else None

    def missing(self, rows: DataFrame) -> DataFrame:
        """The rows whose key is not in the table."""
        known = self.known(rows.select(*map(_quoted, self.key)))
        return rows if known is None else rows.join(known, self.key, "left_anti")

    def lookup(self, keys: DataFrame, schema: str) -> DataFrame:
        """The rows of the table that have one of ``keys``, read from the parts that may hold them."""
        rows = self._read(self.parts_with(keys), schema)
        return rows.join(keys.select(*map(_quoted, self.key)).distinct(), self.key, "left_semi")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
