"""Tables that change in two steps: new files aside first, then an entry in a log that names what the table is now.

Readers go by the newest whole entry, so that a run which ends between the steps leaves the version before it, and files
that no entry names are never read. An entry is one small file under a number of its own, made only if it is not there yet:
of two writers at once one fails. Partitions that did not change stay in the files of the version that wrote them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.sources.files import write_plan
from chronoloom.sources.shared import files_of


#: Times in text forms with all their digits.
OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class Log:
    """Numbered entries under `root`/log, each a JSON object."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _entries(self) -> list[tuple[int, str]]:
        files, at = files_of(self.spark, f"{self.root}/log")
        if not files.exists(at):
            return []
        names = [x.getPath().getName() for x in files.listStatus(at)]
        return sorted((int(n.removesuffix(".json")), n) for n in names if n.removesuffix(".json").isdigit())

    def newest(self) -> tuple[int, dict]:
        """The newest entry that was written to its end, and its number; -1 and nothing if there is none."""
        files, _ = files_of(self.spark, self.root)
        for number, name in reversed(self._entries()):
            path = files_of(self.spark, f"{self.root}/log/{name}")[1]
            stream = files.open(path)
            try:
                text = bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
            finally:
                stream.close()
            try:
                return number, json.loads(text)
            except ValueError:  # ended half-way
                continue
        return -1, {}

    def add(self, entry: dict) -> int:
        found = self._entries()
        number = found[-1][0] + 1 if found else 0
        files, at = files_of(self.spark, f"{self.root}/log/{number:020d}.json")
        out = files.create(at, False)
        try:
            out.write(bytearray(json.dumps(entry, sort_keys=True).encode()))
        finally:
            out.close()
        return number


class Versioned:
    """A table under `root` in partitions by `keys`: data/v=<version>/<keys>, manifest/v=<version> with (keys, hash, v) of
    every partition that the version has, and the log."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], form: str = "parquet"):
        self.spark, self.root, self.keys, self.form, self.log = spark, root, keys, form, Log(spark, root)

    def manifest(self) -> DataFrame | None:
        _, entry = self.log.newest()
        return self.spark.read.schema(entry["manifest"]).parquet(f"{self.root}/manifest/v={entry['version']}") if entry else None

    def read(self) -> DataFrame | None:
        """The table as the newest entry has it; the join prunes the folders of other versions and of gone partitions."""
        _, entry = self.log.newest()
        if not entry:
            return None
        data = self.spark.read.schema(entry["schema"]).format(self.form).options(**OPTIONS).load(f"{self.root}/data")
        live = self.manifest().select("v", *self.keys)
        same = F.lit(True)
        for c in ("v", *self.keys):
            same = same & data[c].eqNullSafe(live[c])
        return data.join(live, same, "left_semi").drop("v")

    def plan(self, hashes: DataFrame, force: bool = False) -> DataFrame:
        """(keys, hash, action, v: where its files are now): write, replace, skip or delete for each partition; hashes has
        (keys, hash)."""
        key = lambda df: df.withColumn("key", F.to_json(F.struct(*self.keys), {"ignoreNullFields": "false"}))
        old = self.manifest()
        old = hashes.select(*self.keys, "hash").filter("false").withColumn("v", F.lit("")) if old is None else old
        actions = write_plan(key(hashes), key(old), force)
        new, was = key(hashes).select("key", *self.keys, "hash"), key(old).select("key", *[F.col(c).alias(f"__{c}") for c in self.keys], F.col("v"))
        both = actions.join(new, "key", "left").join(was, "key", "left")
        return both.select(*[F.coalesce(c, f"__{c}").alias(c) for c in self.keys], "hash", "action", "v")

    def publish(self, rows: DataFrame, hashes: DataFrame, extra: dict | None = None, force: bool = False, before_switch=None) -> dict[str, int]:
        """Writes the partitions of rows whose hash changed, then switches; partitions that rows do not have any more leave
        the table. Nothing is written if all are as they were. before_switch gets the written rows and those that were
        meant, and ends the publication by an error. Returns how many partitions had which action."""
        version, number = uuid.uuid4().hex, self.log.newest()[0]
        plan = self._stored_plan(self.plan(hashes, force), version)
        counts = {r["action"]: r["n"] for r in plan.groupBy("action").agg(F.count("*").alias("n")).collect()}
        if not set(counts) - {"skip"} and number >= 0:
            return counts
        changed = plan.filter(F.col("action").isin("write", "replace")).select(*self.keys)
        same = F.lit(True)
        for c in self.keys:
            same = same & rows[c].eqNullSafe(changed[c])
        fresh = rows.join(changed, same, "left_semi").withColumn("v", F.lit(version))
        fresh.write.mode("append").format(self.form).options(**OPTIONS).partitionBy("v", *self.keys).save(f"{self.root}/data")
        if before_switch and not changed.isEmpty():
            written = self.spark.read.schema(_ddl(fresh)).format(self.form).options(**OPTIONS).load(f"{self.root}/data").filter(F.col("v") == version)
            before_switch(written.drop("v"), fresh.drop("v"))
        kept = plan.filter("action <> 'delete'").select(*self.keys, "hash", F.when(F.col("action") == "skip", F.col("v")).otherwise(F.lit(version)).alias("v"))
        kept.write.parquet(f"{self.root}/manifest/v={version}")
        self.switch({"version": version, "schema": _ddl(fresh), "manifest": _ddl(kept), "partitions": counts, **(extra or {})})
        return counts

    def _stored_plan(self, plan: DataFrame, version: str) -> DataFrame:
        """The plan as a table, so that what is written, kept and told is one and the same."""
        path = f"{self.root}/plan/v={version}"
        plan.write.parquet(path)
        return self.spark.read.schema(plan.schema).parquet(path)

    def switch(self, entry: dict) -> int:
        return self.log.add(entry)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
