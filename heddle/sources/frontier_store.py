"""The frontier as a table on disk that a batch rewrites in part, one version after another.

A url's bucket follows from its host and itself, so a batch of a few hosts touches
few buckets. Only these are read, changed and written anew to a folder of the
batch; a manifest names each bucket's folder. Its renaming into place is the last
step: until then readers see the version before, whatever fails.
"""

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heddle.operators import frontier
from heddle.plans.durable import Scratch

#: Buckets are ``HOSTS`` groups of hosts, each cut into ``PARTS`` by url.
HOSTS, PARTS = 64, 16
TRIES = 3


class Conflict(RuntimeError):
    """Another writer was first with this version."""


class FrontierStore:
    """Versions of a frontier under ``path``; a new one is empty.

    Keys are urls, never null. ``hosts`` and ``parts`` count when the store is made
    and are read from it later on.
    """

    def __init__(self, spark: SparkSession, path: str, hosts: int = HOSTS, parts: int = PARTS):
        self.spark, self.path = spark, path.rstrip("/")
        if not self.versions():
            try:
                self._commit({"version": 0, "hosts": hosts, "parts": parts, "buckets": {}})
            except Conflict:
                pass  # made by another writer meanwhile
        first = self.manifest()
        self.hosts, self.parts = first["hosts"], first["parts"]

    def bucket(self, url: str = "url") -> Column:
        """The bucket of a url; urls without a host share one group."""
        host = F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
        group, part = F.pmod(F.xxhash64(host), F.lit(self.hosts)), F.pmod(F.xxhash64(url), F.lit(self.parts))
        return (group * self.parts + part).cast("int")

    def _path(self, *names: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *names)))

    @property
    def _files(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        if not self._files.exists(self._path("versions")):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(self._path("versions"))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def manifest(self, version: int | None = None) -> dict:
        """What a version, else the last one, consists of: ``buckets`` maps a bucket to its folder and number of rows."""
        stream = self._files.open(self._path("versions", f"{self.versions()[-1] if version is None else version:012}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> None:
        """Put a manifest in place, which no other of its version may hold."""
        manifest = manifest | {"id": uuid.uuid4().hex}
        jvm = self.spark.sparkContext._jvm
        hadoop = jvm.org.apache.hadoop.fs
        aside, final = self._path("versions", f".{uuid.uuid4().hex}"), self._path("versions", f"{manifest['version']:012}.json")
        self._files.mkdirs(final.getParent())
        out = self._files.create(aside, False)
        out.write(json.dumps(manifest).encode())
        out.close()
        context = hadoop.FileContext.getFileContext(final.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            # without an option a rename fails where the name is taken
            context.rename(aside, final, self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0))
        except Exception as error:
            self._files.delete(aside, False)
            if not self._files.exists(final):
                raise
            # the renaming may have been done though its answer was lost
            if self.manifest(manifest["version"])["id"] != manifest["id"]:
                raise Conflict(f"version {manifest['version']} is taken") from error

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], frontier.SCHEMA)
        return self.spark.read.schema(frontier.SCHEMA).parquet(*(f"{self.path}/{f}" for f in folders))

    def state(self, version: int | None = None) -> DataFrame:
        """The whole frontier as of a version, else the last one."""
        return self._read([folder for folder, _ in self.manifest(version)["buckets"].values()])

    def touched(self, urls: DataFrame) -> list[int]:
        """The buckets of a batch, at most as many as the store has."""
        return sorted(r[0] for r in urls.select(self.bucket().alias("bucket")).distinct().collect())

    def update(self, batch: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Replace the buckets of ``batch(url, ...)`` by ``change(batch, their state)``; the number of rows gained.

        The change must leave urls in their buckets, that is, add none but the
        batch's. A writer that finds its version taken begins anew on the state that
        it finds then. A batch of no rows makes no version.
        """
        scratch = Scratch(self.spark, "frontier")
        try:
            batch = scratch.keep(batch.where("url is not null"), "batch")  # read twice, and again after a conflict
            buckets = self.touched(batch)
            for left in reversed(range(TRIES if buckets else 0)):
                try:
                    return self._replace(buckets, batch, change)
                except Conflict:
                    if not left:
                        raise
            return 0
        finally:
            scratch.clear()

    def _replace(self, buckets: list[int], batch: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        before = self.manifest()
        held = before["buckets"]
        known = [held[str(b)] for b in buckets if str(b) in held]
        folder = f"data/{uuid.uuid4().hex}"
        try:
            rows = change(batch, self._read([f for f, _ in known])).withColumn("bucket", self.bucket())
            # a bucket larger than a file's advisory size goes to several tasks
            rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
            schema = f"{frontier.SCHEMA}, bucket int"
            counts = {r["bucket"]: r["count"] for r in self.spark.read.schema(schema).parquet(f"{self.path}/{folder}").groupBy("bucket").count().collect()}
            if strange := counts.keys() - set(buckets):
                raise ValueError(f"rows for buckets outside the batch: {sorted(strange)[:5]}")
            after = {b: v for b, v in held.items() if int(b) not in set(buckets)}
            after |= {str(b): [f"{folder}/bucket={b}", n] for b, n in counts.items()}
            self._commit(before | {"version": before["version"] + 1, "buckets": after})
        except Exception:
            self._files.delete(self._path(folder), True)
            raise
        return sum(counts.values()) - sum(n for _, n in known)

    def add_urls(self, found: DataFrame) -> int:
        """Add the urls of ``found(url, source, first_seen)`` that are new; how many were."""
        return self.update(found.select("url", "source", "first_seen"), frontier.add_urls)

    def apply_fetches(self, fetches: DataFrame) -> None:
        """Take in a batch of ``(url, ts, status, ok, content_hash)``; unknown urls are left out."""
        self.update(fetches.select("url", "ts", "status", "ok", "content_hash"), lambda batch, state: frontier.apply_fetches(state, batch))

    def freeze_cohort(self, n: int, salt: str = "cohort", by: str | None = None) -> None:
        """Put ``n`` more urls, or ``n`` of each value of ``by``, into the panel."""

        def into_panel(batch: DataFrame, state: DataFrame) -> DataFrame:
            chosen = batch.select("url", F.lit(True).alias("_chosen"))
            return state.join(chosen, "url", "left").withColumn("in_panel", F.col("in_panel") | F.coalesce("_chosen", F.lit(False))).drop("_chosen")

        self.update(frontier.freeze_cohort(self.state(), n, salt, by).select("url"), into_panel)

    def vacuum(self, keep: int = 2, hours: float = 24.0) -> int:
        """Delete what none of the last ``keep`` versions names, if it is older than ``hours``; the number of batches' folders.

        Younger folders may be those of a batch that is being written.
        """
        versions = self.versions()
        kept, gone = versions[-keep:], versions[:-keep]
        named = {"/".join(f.split("/")[:2]) for v in kept for f, _ in self.manifest(v)["buckets"].values()}
        for version in gone:
            self._files.delete(self._path("versions", f"{version:012}.json"), False)
        if not self._files.exists(self._path("data")):
            return 0
        limit = (time.time() - hours * 3600) * 1000
        old = [s.getPath().getName() for s in self._files.listStatus(self._path("data")) if s.getModificationTime() <= limit]
        idle = [name for name in old if f"data/{name}" not in named]
        for name in idle:
            self._files.delete(self._path("data", name), True)
        return len(idle)
