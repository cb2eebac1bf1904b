"""Tables as written folders, published together by one small manifest.

A load writes new folders and then publishes a manifest that names them, so readers see all of a
load or none of it, and no job overwrites what it reads. The entry of a partitioned table names
the folders of each part: a load of a dimension with history replaces the current versions and adds
to the closed ones. A table that is added to by many small loads also names the lists of keys that
have gone from its earlier folders (see ``deltas``).

A manifest is published by creating its file, which fails if it is there. It names the version it
was made from, and the last batch of each stream that it holds.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from urllib.parse import urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stardw.session import local_rows
from stardw.sources import deltas

# Stores whose rename copies; there a file appears when it is closed, and ``create`` fails if it is
# there already (of S3 with fs.s3a.create.conditional.enabled, the default of Hadoop 3.4.2).
OBJECT_STORES = {"s3", "s3a", "gs", "oss", "cos", "cosn", "wasb", "wasbs"}
# Tables are written once and read often.
CODEC = "zstd"
# Entries of a manifest that are no tables.
BASE, STREAMS = "_base", "_streams"


class Overtaken(RuntimeError):
    """Another load has published since this one read what it is made from."""


class Warehouse:
    """``warehouse["dim_client"]`` is the published table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    # --- files -------------------------------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _list(self, path: str) -> list[str]:
        fs, at = self._fs(path)
        if not fs.exists(at):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(at))

    def _read_text(self, path: str) -> str:
        fs, at = self._fs(path)
        stream = fs.open(at)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _publish_text(self, path: str, text: str) -> None:
        """Create the file whole and in one step; fails if it is there already."""
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        fs, at = self._fs(path)
        at = fs.makeQualified(at)
        scheme = fs.getUri().getScheme()
        straight = scheme in OBJECT_STORES
        draft = at if straight else jvm.org.apache.hadoop.fs.Path(f"{at}.{uuid.uuid4().hex}.draft")
        try:
            stream = fs.create(draft, False)
            stream.write(bytearray(text, "utf-8"))
            stream.close()
            if scheme == "file":
                # A second name for a file can't be one that is taken, whoever asks at the same time.
                def local(p):
                    return jvm.java.nio.file.Paths.get(p.toUri())
                jvm.java.nio.file.Files.createLink(local(at), local(draft))
            elif not straight:
                kinds = jvm.org.apache.hadoop.fs.Options.Rename
                keep = self.spark.sparkContext._gateway.new_array(kinds, 1)
                keep[0] = kinds.NONE
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), conf).rename(
                    draft, at, keep)
        except Py4JJavaError as problem:
            if not fs.exists(at):
                raise
            raise Overtaken(f"{path} was published by another load") from problem
        finally:
            if not straight:
                fs.delete(draft, False)

    # --- manifest ----------------------------------------------------------------------------

    def _versions(self) -> list[str]:
        return [n for n in self._list(f"{self.root}/_manifest") if n.endswith(".json")]

    def snapshot(self) -> tuple[int, dict]:
        """Number and entries of the newest manifest; 0 and nothing if there is none."""
        versions = self._versions()
        if not versions:
            return 0, {}
        return (int(versions[-1].split(".")[0]),
                json.loads(self._read_text(f"{self.root}/_manifest/{versions[-1]}")))

    def manifest(self) -> dict:
        """The entries of the tables."""
        return {t: e for t, e in self.snapshot()[1].items() if not t.startswith("_")}

    def version(self) -> int:
        """Number of the newest manifest, 0 if there is none."""
        versions = self._versions()
        return int(versions[-1].split(".")[0]) if versions else 0

    def holds(self, batch: tuple[str, int]) -> bool:
        """Whether a batch of a stream, (stream, number), has been published."""
        stream, number = batch
        return self.snapshot()[1].get(STREAMS, {}).get(stream, -1) >= number

    def commit(self, entries: dict, base: int | None = None,
               batch: tuple[str, int] | None = None) -> bool:
        """Publish new entries; tables that are not named keep theirs.

        ``base`` is the version the entries were made from. If it is no longer the newest, another
        load has published meanwhile, and this one must start again. A ``batch`` of a stream that
        has been published is not published again, and the answer is False.
        """
        newest, known = self.snapshot()
        streams = known.get(STREAMS, {})
        if batch is not None and streams.get(batch[0], -1) >= batch[1]:
            return False
        if base is not None and base != newest:
            raise Overtaken(f"version {newest} was published since version {base} was read")
        if batch is not None:
            streams = {**streams, batch[0]: batch[1]}
        text = json.dumps({**known, **entries, BASE: newest,
                           **({STREAMS: streams} if streams else {})}, sort_keys=True)
        self._publish_text(f"{self.root}/_manifest/{newest + 1:010d}.json", text)
        return True

    @staticmethod
    def _lots(entries) -> set[str]:
        """The folders that entries name."""
        if isinstance(entries, dict):
            entries = list(entries.values())
        if isinstance(entries, list):
            return set().union(*map(Warehouse._lots, entries))
        return {entries} if isinstance(entries, str) and entries.startswith("lot=") else set()

    def _folders(self) -> list[str]:
        """All written folders of tables."""
        found = []
        for table in self._list(self.root):
            if table.startswith("_"):
                continue
            inner = [f"{table}/{n}" for n in self._list(f"{self.root}/{table}")]
            if table == "staging":
                inner = [f"{t}/{n}" for t in inner for n in self._list(f"{self.root}/{t}")]
            found += [p for p in inner if p.split("/")[-1].startswith("lot=")]
        return found

    def _delete(self, paths: list[str]) -> None:
        for path in paths:
            fs, at = self._fs(f"{self.root}/{path}")
            fs.delete(at, True)
        self._opened.clear()

    def discard(self, entries: dict) -> None:
        """Delete the folders of entries that no manifest names."""
        lots = self._lots(entries)
        for version in self._versions():
            lots -= self._lots(json.loads(self._read_text(f"{self.root}/_manifest/{version}")))
        self._delete([p for p in self._folders() if p.split("/")[-1] in lots])

    def expire(self, keep: int = 7) -> list[str]:
        """Delete the folders that the last ``keep`` manifests do not name, and older manifests.

        Not to be called while a load or a reader of an older manifest is at work.
        """
        versions = self._versions()
        named: set[str] = set()
        for version in versions[-keep:]:
            named |= self._lots(json.loads(self._read_text(f"{self.root}/_manifest/{version}")))
        gone = [p for p in self._folders() if p.split("/")[-1] not in named]
        gone += [f"_manifest/{v}" for v in versions[:-keep]]
        self._delete(gone)
        return gone

    def __contains__(self, table: str) -> bool:
        return table in self.manifest()

    def __getitem__(self, table: str) -> DataFrame:
        return self.open(table, self.manifest()[table])

    # --- tables ------------------------------------------------------------------------------

    def write(self, table: str, df: DataFrame, partition: str | list[str] | None = None,
              order: str | None = None, observe: dict[str, Column] | None = None,
              finish: Callable[[DataFrame], DataFrame] | None = None) -> dict:
        """Write a new folder for ``table`` and give its entry, still unpublished.

        With ``order``, rows are brought together by part and sorted, for tables of many parts.
        ``finish`` adds columns to them afterwards, so that these are neither moved nor sorted.
        The job counts what it writes, as ``rows`` of the entry, and works out the aggregates
        ``observe`` on the way, as ``observed``.
        """
        lot = f"lot={uuid.uuid4().hex[:12]}"
        path = f"{self.root}/{table}/{lot}"
        levels = [partition] if isinstance(partition, str) else partition or []
        if order is not None:
            # Rebalancing splits a part that is too large for one task and joins small ones.
            df = df.hint("rebalance", *levels).sortWithinPartitions(*levels, order)
        if finish is not None:
            df = finish(df)
        schema = df.schema.jsonValue()
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"),
                        *[c.alias(name) for name, c in (observe or {}).items()])
        if not levels:
            df.write.mode("error").parquet(path, compression=CODEC)
        else:
            df.write.mode("error").partitionBy(*levels).parquet(path, compression=CODEC)
        # A plan that turns out to be empty while it runs counts nothing.
        found = dict(seen.get)
        entry = {"schema": schema, "rows": found.pop("rows", 0)}
        if observe:
            entry["observed"] = found
        if not levels:
            return {**entry, "lot": lot}
        names = [""]
        for level in levels:
            names = [f"{above}/{n}" for above in names for n in self._list(f"{path}{above}")
                     if n.startswith(f"{level}=")]
        # A part is named by its value, and by the folders below that if there are more levels.
        return {**entry, "partition": levels[0],
                "parts": {n.removeprefix(f"/{levels[0]}="): [lot] for n in names}}

    def open(self, table: str, entry: dict) -> DataFrame:
        """The DataFrame of an entry, published or not. Written folders never change, so their
        files are listed once."""
        known = json.dumps([table, entry], sort_keys=True)
        if known not in self._opened:
            self._opened[known] = self._open(table, entry)
        return self._opened[known]

    def _open(self, table: str, entry: dict) -> DataFrame:
        schema = T.StructType.fromJson(entry["schema"])
        if "partition" not in entry:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}/{entry['lot']}")
        if not entry["parts"]:
            return local_rows(self.spark, [], schema)
        if entry.get("gone"):
            return deltas.merged(self, table, entry, schema)
        return self.parts(table, entry["parts"], entry["partition"], schema).select(*schema.names)

    def parts(self, table: str, parts: dict, partition: str, schema: T.StructType) -> DataFrame:
        """The rows of some parts, with the column ``lot`` that names their folder."""
        base = f"{self.root}/{table}"
        paths = [f"{base}/{lot}/{partition}={value}" for value, lots in sorted(parts.items())
                 for lot in lots]
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
