"""Layer versions (S2): staged folders, manifests, releases that are swapped in whole, retention.

Layout of a store, on any Hadoop file system::

    {root}/data/{layer}/{version}/...        files of one version, written once
    {root}/manifests/{layer}/{version}.json  written when a version is complete
    {root}/releases/{number}.json            layer -> version; the highest number is what readers see
    {root}/pins/{token}.json                 versions that a reader holds, and until when

A version is never changed. A release is one small file, written under a
temporary name and renamed to the next number; the rename fails if that number
exists, so of two publishers one has to look again, and readers see either all
layers of a release or none. What no release, pin or fresh manifest refers to is
removed by :meth:`VersionStore.sweep` after a grace period.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.sources.tables import STORED


class Conflict(RuntimeError):
    """Another publisher took the release number first."""


class HadoopFiles:
    """The few file operations a store needs, through the Hadoop file system of the path."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path(root).getFileSystem(self.conf)

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def sizes(self, folder: str) -> dict[str, int]:
        """Every file under a folder, by its path from there."""
        p, out = self._path(folder), {}
        if self.fs.exists(p):
            base, files = self.fs.makeQualified(p).toString().rstrip("/") + "/", self.fs.listFiles(p, True)
            while files.hasNext():
                f = files.next()
                out[f.getPath().toString().removeprefix(base)] = f.getLen()
        return out

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """Write a new file as a whole; :class:`Conflict` if it exists already."""
        target, folder = self._path(path), path.rsplit("/", 1)[0]
        self.fs.mkdirs(self._path(folder))
        temporary = self._path(f"{folder}/.tmp-{uuid.uuid4().hex}")
        stream = self.fs.create(temporary, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        options = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self.fs.makeQualified(temporary), self.fs.makeQualified(target), options)
        except Exception as error:
            self.fs.delete(temporary, False)
            if "FileAlreadyExists" in str(error):
                raise Conflict(path) from error
            raise

    def remove(self, path: str) -> bool:
        return self.fs.delete(self._path(path), True)


@dataclass(frozen=True)
class Version:
    """A complete version of a layer."""

    layer: str
    version: str
    fingerprint: str            # what it was built from; equal fingerprints are built once
    created: float
    schema: str                 # Spark's JSON, in the builder's column order
    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    files: dict[str, int] = field(default_factory=dict, compare=False)


class VersionStore:
    """Versions of layers under one shared folder."""

    def __init__(self, spark: SparkSession, root: str, clock: Callable[[], float] = time.time):
        self.spark, self.root, self.clock = spark, root.rstrip("/"), clock
        self.files = HadoopFiles(spark, self.root)

    def path(self, v: Version) -> str:
        return f"{self.root}/data/{v.layer}/{v.version}"

    @staticmethod
    def _table(layer: str, version: str) -> str:
        return f"version_{layer}_{version.replace('-', '_')}"

    # ------------------------------------------------------------- versions
    def versions(self, layer: str) -> list[Version]:
        """Complete versions, oldest first."""
        folder = f"{self.root}/manifests/{layer}"
        found = [json.loads(self.files.read(f"{folder}/{n}")) for n in self.files.names(folder) if not n.startswith(".")]
        # a manifest of an earlier release of this library may lack later fields
        return sorted((Version(**{**v, **{c: tuple(v.get(c, ())) for c in ("partition_by", "bucket_by")}}) for v in found), key=lambda v: (v.created, v.version))

    def stage(self, layer: str, fingerprint: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = (),
              bucket_by: Sequence[str] = (), buckets: int | None = None, dealt: bool = False) -> Version:
        """The version of ``layer`` built from ``fingerprint``; written if there is none yet.

        Its files are complete before the manifest names them. Readers don't
        see it before a release names it. With ``bucket_by`` the rows are stored by
        hash and sorted on these columns, in ``buckets`` files (the session's
        shuffle partitions): whatever groups, deduplicates or joins on them reads
        them without an exchange. ``dealt`` says that ``build`` gives its rows in
        that many partitions by hash of these columns: they are not dealt again.
        """
        for v in reversed(self.versions(layer)):
            if v.fingerprint == fingerprint and self.intact(v):
                return v
        number = f"{int(self.clock() * 1000):015d}-{uuid.uuid4().hex[:8]}"
        df = build()
        path = f"{self.root}/data/{layer}/{number}"
        n = (buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))) if bucket_by else 0
        # rows of a partition or bucket come together first, else every task would write a file for each
        if bucket_by:
            df = df if dealt else df.repartition(n, *bucket_by)
            writer = df.write.bucketBy(n, *bucket_by).sortBy(*bucket_by)
        else:
            writer = (df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df).write
        writer = (writer.partitionBy(*partition_by) if partition_by else writer).options(**STORED)
        if bucket_by:
            writer.option("path", path).format("parquet").saveAsTable(self._table(layer, number))
        else:
            writer.parquet(path)
        v = Version(layer, number, fingerprint, self.clock(), df.schema.json(), tuple(partition_by), tuple(bucket_by), n, self.files.sizes(path))
        self.files.create(f"{self.root}/manifests/{layer}/{number}.json", json.dumps(asdict(v)))
        return v

    def read(self, v: Version, by_bucket: bool = True) -> DataFrame:
        """A version's rows, columns in the builder's order and of its types; without ``by_bucket`` as plain files."""
        schema = StructType.fromJson(json.loads(v.schema))
        if v.buckets and by_bucket:
            # the catalog holds the distribution; an application that hasn't written the version registers its files
            name, cols = self._table(v.layer, v.version), ", ".join(f"`{c}`" for c in v.bucket_by)
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet "
                           f"CLUSTERED BY ({cols}) SORTED BY ({cols}) INTO {v.buckets} BUCKETS LOCATION '{self.path(v)}'")
            return self.spark.table(name)
        return self.spark.read.schema(schema).parquet(self.path(v)).select(*[f"`{c}`" for c in schema.names])

    def intact(self, v: Version) -> bool:
        """Whether the version's files are those that its manifest lists."""
        return self.files.sizes(self.path(v)) == v.files

    # ------------------------------------------------------------- releases
    def _numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.files.names(f"{self.root}/releases") if not n.startswith("."))

    def release(self, number: int | None = None) -> dict[str, str]:
        """layer -> version of a release (the newest one); empty if nothing was published."""
        numbers = self._numbers()
        if not numbers:
            return {}
        return json.loads(self.files.read(f"{self.root}/releases/{number or numbers[-1]:012d}.json"))

    def publish(self, versions: Sequence[Version], based_on: int | None = None) -> int:
        """Make ``versions`` visible together; layers that aren't named stay as they are.

        ``based_on`` is the release that the publisher has seen; if another one
        came in between, :class:`Conflict` is raised and nothing changes.
        """
        last = (self._numbers() or [0])[-1]
        if based_on is not None and based_on != last:
            raise Conflict(f"release {last} was published after {based_on}")
        named = {**self.release(), **{v.layer: v.version for v in versions}}
        self.files.create(f"{self.root}/releases/{last + 1:012d}.json", json.dumps(named))
        return last + 1

    def latest(self) -> int:
        return (self._numbers() or [0])[-1]

    def published(self, layer: str, number: int | None = None) -> Version:
        name = self.release(number).get(layer)
        for v in self.versions(layer):
            if v.version == name:
                return v
        raise FileNotFoundError(f"{layer} has no published version under {self.root}")

    # ------------------------------------------------------------- retention
    def pin(self, versions: Sequence[Version], seconds: float) -> str:
        """Keep versions for a reader until ``seconds`` from now; gives a token for :meth:`unpin`."""
        token = uuid.uuid4().hex
        held = {"until": self.clock() + seconds, "versions": [[v.layer, v.version] for v in versions]}
        self.files.create(f"{self.root}/pins/{token}.json", json.dumps(held))
        return token

    def unpin(self, token: str) -> None:
        self.files.remove(f"{self.root}/pins/{token}.json")

    def sweep(self, grace: float, keep: Callable[[Version], bool] = lambda v: False) -> list[tuple[str, str]]:
        """Remove what nothing refers to and is older than ``grace`` seconds.

        Referred to are the versions of the newest release, those under a pin
        that hasn't run out, and those that ``keep`` names. Folders of writes that
        never completed are removed after the same time. The manifest goes
        first, so no reader finds a version whose files are being removed.
        """
        now, held = self.clock(), set(self.release().items())
        for n in self.files.names(f"{self.root}/pins"):
            pin = json.loads(self.files.read(f"{self.root}/pins/{n}"))
            if pin["until"] >= now:
                held |= {tuple(v) for v in pin["versions"]}
            else:
                self.files.remove(f"{self.root}/pins/{n}")
        gone = []
        for layer in self.files.names(f"{self.root}/data"):
            known = {v.version: v for v in self.versions(layer)}
            for version in self.files.names(f"{self.root}/data/{layer}"):
                v = known.get(version)
                born = v.created if v else int(version.split("-")[0]) / 1000
                if (layer, version) in held or now - born < grace or v and keep(v):
                    continue
                if v:
                    self.files.remove(f"{self.root}/manifests/{layer}/{version}.json")
                    if v.buckets:
                        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(layer, version)}")
                self.files.remove(f"{self.root}/data/{layer}/{version}")
                gone.append((layer, version))
        return gone


def fingerprint_of(parts: Mapping[str, object]) -> str:
    """A stable digest of what a layer is built from."""
    import hashlib
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:24]
