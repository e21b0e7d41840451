"""A layered table store on plain Parquet directories.

A thin wrapper over ``DataFrameReader``/``DataFrameWriter`` -- layout
conventions only:

``<root>/<layer>/<table>/``
    *append tables* (bronze): one directory, Hive-style partitions,
    written with dynamic partition overwrite so replaying a batch
    replaces exactly that batch's partitions (idempotent append).
``<root>/<layer>/<table>/_v=<version>/``
    *replace tables* (silver, quarantine, gold, full-refresh bronze):
    every rebuild writes a fresh version directory; readers resolve the
    newest version whose write committed (``_SUCCESS`` marker written by
    Spark's output committer).  A failed rebuild therefore never exposes
    a half-written table and the previous version stays readable.

A reader that still holds a plan on a version keeps it until
``keep_versions`` newer ones are committed (2 unless set otherwise): raise
it where plans outlive rebuilds.  One writer per table at a time: a rebuild
removes what earlier attempts left uncommitted.

Append tables record their schema beside the data, so partition values
read back with the type they were written with (a batch id ``0001`` stays
text).

A silver table and its quarantine are written together (``replace_split``):
one version directory, partitioned by whether a row passed.  Readers of
either layer see their side of it.  ``swap_split`` replaces some of its
partitions: they are written beside the version first (``stage``), then swapped
in while the version's ``_SUCCESS`` is away, so a swap that dies halfway shows
the version before, never a mixture.

``compact`` merges the small files of an append table's partitions.  The merged
files are written whole beside the table, then take the place of each partition.
If that dies, the next write to the table finishes it, and until then readers
take a partition that is away from where its merged files lie.

Logs (``log``) are append tables with one directory for each key, written by
one writer each, so that jobs of different keys can log at the same time.
Their small files are merged now and then.

The root must be shared storage on a cluster (HDFS, object store); the
filesystem calls go through Hadoop's ``FileSystem`` of that path.
"""
from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LAYERS = ("bronze", "silver", "gold", "quarantine", "control")
_VERSION_PREFIX = "_v="
_SUCCESS = "_SUCCESS"
_SCHEMA = "_strata_schema.json"
_STAGED = "_staged-"
_COMPACTED = "_compacted-"
_PASSED = "_passed"
PASSED = _PASSED
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Held while a log's schema is first written: jobs of one run log side by side.
_FIRST = threading.Lock()
#: Files of one key's log that are merged into one.
LOG_FILES = 16


class TableNotFound(LookupError):
    pass


def empty_frame(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """An empty DataFrame built in the JVM (no Python-side RDD, so no
    Python worker start-up just to produce zero rows)."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


class TableStore:
    def __init__(self, spark: SparkSession, root: str, keep_versions: int = 2):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep_versions = max(1, keep_versions)

    # -- filesystem ---------------------------------------------------
    def _path(self, p: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs, path

    def _exists(self, p: str) -> bool:
        fs, path = self._path(p)
        return bool(fs.exists(path))

    def _children(self, p: str) -> list[str]:
        fs, path = self._path(p)
        if not fs.exists(path):
            return []
        return [st.getPath().getName() for st in fs.listStatus(path)]

    def _delete(self, p: str) -> None:
        fs, path = self._path(p)
        fs.delete(path, True)

    def _move(self, source: str, target: str) -> None:
        fs, path = self._path(target)
        fs.mkdirs(path.getParent())
        if not fs.rename(self._path(source)[1], path):
            raise OSError(f"cannot move {source} to {target}")

    # -- layout -------------------------------------------------------
    def ensure_layers(self) -> None:
        """K8: create the five layer directories."""
        for layer in LAYERS:
            fs, path = self._path(f"{self.root}/{layer}")
            fs.mkdirs(path)

    def table_path(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root}/{layer}/{name}"

    def _versions(self, layer: str, name: str) -> list[str]:
        base = self.table_path(layer, name)
        names = sorted(c for c in self._children(base) if c.startswith(_VERSION_PREFIX))
        return [n for n in names if self._exists(f"{base}/{n}/{_SUCCESS}")]

    def _side(self, layer: str, name: str) -> str | None:
        """The directory of a split version that holds the layer's rows."""
        if layer not in ("silver", "quarantine"):
            return None
        versions = self._versions("silver", name)
        if not versions or not self._exists(f"{(at := self.table_path('silver', name))}/{versions[-1]}/{layer}{_SCHEMA}"):
            return None
        return f"{at}/{versions[-1]}/{_PASSED}={'true' if layer == 'silver' else 'false'}"

    def current_path(self, layer: str, name: str) -> str | None:
        side = self._side(layer, name)
        if side is not None:
            return side
        base = self.table_path(layer, name)
        versions = self._versions(layer, name)
        if versions:
            return f"{base}/{versions[-1]}"
        if self._has_data(base):
            return base
        return None

    def _has_data(self, base: str) -> bool:
        """Append tables: any partition directory or data file."""
        for c in self._children(base):
            if c.startswith(_VERSION_PREFIX):
                continue
            if "=" in c or not c.startswith(("_", ".")):
                return True
        return False

    def exists(self, layer: str, name: str) -> bool:
        return self.current_path(layer, name) is not None

    # -- read ---------------------------------------------------------
    def read(self, layer: str, name: str) -> DataFrame:
        """The committed table; raises ``TableNotFound``."""
        path = self.current_path(layer, name)
        if path is None:
            raise TableNotFound(f"{layer}.{name}")
        if path.rsplit("/", 1)[-1].startswith(f"{_PASSED}="):
            recorded = f"{path.rsplit('/', 1)[0]}/{layer}{_SCHEMA}"
            schema = StructType.fromJson(json.loads(self._read_text(recorded)))
            if not self._has_data(path):
                return empty_frame(self.spark, schema)
            return self.spark.read.schema(schema).option("basePath", path).parquet(path)
        if not self._has_data(path) and self._exists(f"{path}/{_SCHEMA}"):
            # an empty rebuild: no data files, only the recorded schema
            schema = StructType.fromJson(json.loads(self._read_text(f"{path}/{_SCHEMA}")))
            return empty_frame(self.spark, schema)
        schema = None if path.rsplit("/", 1)[-1].startswith(_VERSION_PREFIX) else self._recorded(path)
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        df = reader.parquet(path)
        for staged, parts in self._away(path).items():
            there = [f"{staged}/{p}" for p in parts]
            df = df.unionByName(self.spark.read.schema(schema).option("basePath", staged).parquet(*there))
        return df

    def _recorded(self, path: str) -> StructType | None:
        at = f"{path}/{_SCHEMA}"
        return StructType.fromJson(json.loads(self._read_text(at))) if self._exists(at) else None

    def recorded(self, layer: str, name: str) -> StructType | None:
        """The schema kept beside an append table's data."""
        return self._recorded(self.table_path(layer, name))

    def _read_text(self, p: str) -> str:
        fs, path = self._path(p)
        stream = fs.open(path)
        try:
            reader = self.spark.sparkContext._jvm.java.io.BufferedReader(
                self.spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8")
            )
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()

    def _write_text(self, p: str, text: str) -> None:
        fs, path = self._path(p)
        out = fs.create(path, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def remember(self, path: str, text: str) -> str:
        """The text kept at ``path``; ``text`` is kept there first if none is."""
        if not self._exists(path):
            self._write_text(path, text)
        return self._read_text(path)

    def read_or_empty(self, layer: str, name: str, schema: StructType | str) -> DataFrame:
        """K7 for readers: a missing table reads as empty with ``schema``."""
        if self.exists(layer, name):
            return self.read(layer, name)
        return empty_frame(self.spark, schema)

    # -- write --------------------------------------------------------
    def replace(
        self,
        layer: str,
        name: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        retire: bool = True,
    ) -> str:
        """K1/K3/K4/K5: write a new version, then retire old ones."""
        base = self.table_path(layer, name)
        version = f"{_VERSION_PREFIX}{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
        target = f"{base}/{version}"
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(target)
        # The schema travels with the version, so an empty rebuild (no data
        # files) still reads back with its columns.
        self._write_text(f"{target}/{_SCHEMA}", df.schema.json())
        if retire:
            self._retire(layer, name, target)
        return target

    def _retire(self, layer: str, name: str, target: str) -> None:
        base, version = target.rsplit("/", 1)
        for old in self._versions(layer, name)[: -self.keep_versions]:
            self._delete(f"{base}/{old}")
        # leftovers of earlier attempts that never committed
        committed = set(self._versions(layer, name))
        for child in self._children(base):
            if child.startswith(_VERSION_PREFIX) and child < version and child not in committed or child.startswith(_STAGED):
                self._delete(f"{base}/{child}")

    def remove(self) -> None:
        """The whole store (scratch stores of queries)."""
        self._delete(self.root)

    def tables(self) -> list[tuple[str, str]]:
        """(layer, table) of all committed tables."""
        found = [(layer, t) for layer in LAYERS for t in sorted(self._children(f"{self.root}/{layer}"))]
        found += [("quarantine", t) for layer, t in found if layer == "silver"]
        return [x for x in dict.fromkeys(found) if self.exists(*x)]

    def create_views(self) -> list[str]:
        """A temporary view ``<layer>_<table>`` for each committed table, so
        SQL can name it."""
        names = []
        for layer, table in self.tables():
            self.read(layer, table).createOrReplaceTempView(f"{layer}_{table}")
            names.append(f"{layer}_{table}")
        return names

    def replace_split(self, name: str, df: DataFrame, passed: str, reason: str, partition_by: Sequence[str]) -> str:
        """K3 + K4 in one write: rows whose boolean ``passed`` is true become
        the silver table (without ``reason``), the others its quarantine
        (without ``partition_by``)."""
        rest = [f for f in df.schema.fields if f.name not in (passed, reason, *partition_by)]
        parts = [df.schema[c] for c in partition_by]
        version = self.replace("silver", name, df.withColumnRenamed(passed, _PASSED), [_PASSED, *partition_by], retire=False)
        self._write_text(f"{version}/quarantine{_SCHEMA}", StructType(rest + [df.schema[reason]]).json())
        self._write_text(f"{version}/silver{_SCHEMA}", StructType(rest + parts).json())
        self._retire("silver", name, version)
        return version

    def split_version(self, name: str) -> str | None:
        """Directory of the silver table's current version, if it holds the
        quarantine too."""
        side = self._side("silver", name)
        return side.rsplit("/", 1)[0] if side else None

    def read_split(self, name: str) -> DataFrame:
        """All rows of a silver table and its quarantine, with ``PASSED``, the
        reason and the partition columns."""
        at = self.split_version(name)
        if at is None:
            raise TableNotFound(f"silver.{name}")
        schema = self._recorded(at)
        return self.spark.read.schema(schema).parquet(at) if self._has_data(at) else empty_frame(self.spark, schema)

    def staging(self, name: str) -> str:
        """A new folder beside a silver table's versions, for what is about to
        take the place of partitions; the next rebuild removes forgotten ones."""
        return f"{self.table_path('silver', name)}/{_STAGED}{uuid.uuid4().hex[:8]}"

    def stage(self, path: str, df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
        """Writes ``df`` there; the rows as they are read back."""
        df.write.partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path) if self._has_data(path) else empty_frame(self.spark, df.schema)

    def staged_values(self, path: str, partition: str) -> list[str | None]:
        """Values of the innermost partition column of what ``stage`` wrote."""
        found = dict.fromkeys(p.rsplit("/", 1)[-1].partition("=")[2] for p in self._partitions(path))
        return [None if v == NULL_PARTITION else v for v in found]

    def unstage(self, path: str) -> None:
        self._delete(path)

    def swap_split(self, name: str, staged: Sequence[str], partition: str, values: Sequence[str | None]) -> None:
        """Replaces the partitions of ``values`` on both sides by the rows that
        lie in the ``staged`` folders, all of which belong to them; other files
        stay as they are."""
        at = self.split_version(name)
        self._delete(f"{at}/{_SUCCESS}")
        for side in ("true", "false"):
            for value in values:
                self._delete(f"{at}/{_PASSED}={side}/{partition}={NULL_PARTITION if value is None else value}")
            for folder in staged:
                for part in self._children(f"{folder}/{_PASSED}={side}"):
                    target = f"{at}/{_PASSED}={side}/{part}"
                    if not self._exists(target):
                        self._move(f"{folder}/{_PASSED}={side}/{part}", target)
                        continue
                    for file in self._children(f"{folder}/{_PASSED}={side}/{part}"):
                        self._move(f"{folder}/{_PASSED}={side}/{part}/{file}", f"{target}/{file}")
        self._write_text(f"{at}/{_SUCCESS}", "")

    def log(self, name: str, key: str, value: str, row: DataFrame) -> None:
        """Adds ``row`` to the part of ``control.<name>`` whose ``key`` is ``value``."""
        path = self.table_path("control", name)
        fields = [f for f in row.schema.fields if f.name != key]
        with _FIRST:
            if not self._exists(f"{path}/{_SCHEMA}"):
                self._write_text(f"{path}/{_SCHEMA}", StructType(fields + [row.schema[key]]).json())
        part = f"{path}/{key}={value}"
        row.drop(key).write.mode("append").parquet(part)
        files = [c for c in self._children(part) if not c.startswith(("_", "."))]
        if len(files) >= LOG_FILES:
            # Rows are in both for a moment; all readers take a key's latest.
            merged = f"{path}/{_STAGED}{uuid.uuid4().hex[:8]}"
            self.spark.read.schema(StructType(fields)).parquet(part).coalesce(1).write.parquet(merged)
            for c in self._children(merged):
                if not c.startswith(("_", ".")):
                    self._move(f"{merged}/{c}", f"{part}/{c}")
            for c in files:
                self._delete(f"{part}/{c}")
            self._delete(merged)

    def append(
        self,
        layer: str,
        name: str,
        df: DataFrame,
        partition_by: Sequence[str],
        idempotent: bool = True,
    ) -> str:
        """K2: append.  ``idempotent`` (default) writes with dynamic
        partition overwrite, so a replayed batch replaces its own
        partitions and nothing else; otherwise rows are simply added
        (logs)."""
        if not partition_by:
            raise ValueError("append tables need partition columns")
        path = self.table_path(layer, name)
        self._finish_compaction(path)
        have = self._recorded(path)
        new = [f for f in df.schema.fields if have is None or f.name not in have.names]
        if new:  # the partition columns last, as they are read
            fields = [f for f in (have.fields if have else []) + new if f.name not in partition_by]
            parts = [next(f for f in df.schema.fields if f.name == c) for c in partition_by]
            self._write_text(f"{path}/{_SCHEMA}", StructType(fields + parts).json())
        writer = df.write.partitionBy(*partition_by)
        if idempotent:
            writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        else:
            writer = writer.mode("append")
        writer.parquet(path)
        return path

    def _partitions(self, path: str) -> list[str]:
        """The innermost partition directories below ``path``."""
        found = []
        for c in self._children(path):
            if "=" in c:
                found += [f"{c}/{p}" for p in self._partitions(f"{path}/{c}")] or [c]
        return found

    def _compactions(self, path: str) -> list[str]:
        """Compactions of the table that are written whole but not yet through."""
        begun = [f"{path}/{c}" for c in self._children(path) if c.startswith(_COMPACTED)]
        return [c for c in begun if self._exists(f"{c}/{_SUCCESS}")]

    def _away(self, path: str) -> dict[str, list[str]]:
        """Partitions a compaction has removed and not yet replaced."""
        gone = {c: [p for p in self._partitions(c) if self._children(f"{c}/{p}") and not self._exists(f"{path}/{p}")] for c in self._compactions(path)}
        return {c: parts for c, parts in gone.items() if parts}

    def _finish_compaction(self, path: str) -> None:
        """Swaps in what a compaction has written; whatever is left of one that
        died before is removed."""
        for done in self._compactions(path):
            for part in self._partitions(done):
                self._delete(f"{path}/{part}")
                self._move(f"{done}/{part}", f"{path}/{part}")
        for c in self._children(path):
            if c.startswith(_COMPACTED):
                self._delete(f"{path}/{c}")

    def _file_sizes(self, path: str) -> tuple[int, int]:
        fs, at = self._path(path)
        summary = fs.getContentSummary(at)
        return int(summary.getFileCount()), int(summary.getLength())

    def compact(self, layer: str, name: str, slack: int = 4) -> int:
        """K2: merges the files of the append table's partitions that have more
        than one file, and more than ``slack`` for each advisory partition size
        (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) of data.  Rows
        and partitions stay; a partition is at least one file.  One job for all
        of them: Spark brings a partition together and splits one beyond that
        size.  Returns how many partitions were merged."""
        path = self.table_path(layer, name)
        schema = self._recorded(path)
        if schema is None or self._versions(layer, name):
            return 0
        self._finish_compaction(path)
        advisory = self.spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
            self.spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        )
        small = []
        for part in self._partitions(path):
            files, size = self._file_sizes(f"{path}/{part}")
            if files > 1 and files > slack * (size // advisory):
                small.append(part)
        if not small:
            return 0
        by = [p.partition("=")[0] for p in small[0].split("/")]
        rows = self.spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{p}" for p in small])
        rows.hint("rebalance", *by).write.partitionBy(*by).parquet(f"{path}/{_COMPACTED}{uuid.uuid4().hex[:8]}")
        self._finish_compaction(path)
        return len(small)

    def drop_partition(self, layer: str, name: str, values: Mapping[str, str]) -> None:
        """Remove one partition of an append table, if it is there."""
        self._finish_compaction(self.table_path(layer, name))
        part = "/".join(f"{k}={v}" for k, v in values.items())
        path = f"{self.table_path(layer, name)}/{part}"
        if self._exists(path):
            self._delete(path)

    def drop_if_empty(self, layer: str, name: str) -> None:
        """Remove a table directory that holds no data files (an empty
        first write leaves only the commit marker)."""
        base = self.table_path(layer, name)
        if self._has_data(base) or self._versions(layer, name):
            return
        if self._exists(base):
            self._delete(base)
