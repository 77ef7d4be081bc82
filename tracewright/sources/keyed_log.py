"""A keyed store as a log: every change is a version, deletions are tombstones, old versions stay readable until compaction.

Under one path of the shared file system lie ``v=N`` (rows of version N, each with ``op`` put or
delete), ``v=N.clear`` (version N empties the store) and ``base=N`` (what the store held at N). A
version appears by the rename of a finished folder, so readers see it whole or not at all, and of
two writers of one number the second fails and takes the next.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class KeyedLog:
    """Rows of ``schema`` (a DDL string), one for each value of ``keys``; null keys are keys like any other."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: str):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self.schema = StructType.fromDDL(schema)
        self._stored = StructType.fromDDL(f"{schema}, op string, version bigint")

    def _fs(self):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), self.spark._jvm.org.apache.hadoop.fs.Path

    def _listed(self) -> dict[str, list[int]]:
        """The versions of each kind: rows, clear, base."""
        fs, at = self._fs()
        out = {"rows": [], "clear": [], "base": []}
        if fs.exists(at(self.path)):
            for s in fs.listStatus(at(self.path)):
                name = s.getPath().getName()
                if name.startswith("base="):
                    out["base"].append(int(name[5:]))
                elif name.startswith("v="):
                    out["clear" if name.endswith(".clear") else "rows"].append(int(name[2:].removesuffix(".clear")))
        return {k: sorted(v) for k, v in out.items()}

    def version(self) -> int:
        """The newest version, 0 for a new store."""
        found = self._listed()
        return max([0, *found["rows"], *found["clear"], *found["base"]])

    def _publish(self, write, suffix: str = "") -> int:
        fs, at = self._fs()
        fs.mkdirs(at(self.path))
        while True:
            marks = [s.getPath().getName() for s in fs.listStatus(at(self.path))]
            n = max([self.version(), *[int(m[7:]) for m in marks if m.startswith(".taken-")]]) + 1
            made = f"{self.path}/.making-{uuid.uuid4().hex}"
            write(made, n)
            # The mark of a number is made by one writer alone; a second one, or one after a writer that died, takes the next.
            if fs.createNewFile(at(f"{self.path}/.taken-{n}")) and fs.rename(at(made), at(f"{self.path}/v={n}{suffix}")):
                return n
            fs.delete(at(made), True)

    def _append(self, rows: DataFrame, op: str) -> int:
        """Rows that lack columns have nulls there."""
        cols = [(F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        made = rows.select(*cols, F.lit(op).alias("op"))
        return self._publish(lambda to, n: made.withColumn("version", F.lit(n).cast("long")).write.parquet(to))

    def put(self, rows: DataFrame) -> int:
        """Inserts or replaces; of several rows of a key the greatest stays. Returns the version."""
        rest = [f.name for f in self.schema.fields if f.name not in self.keys]
        one = rows.groupBy(*self.keys).agg(F.max(F.struct(*rest)).alias("__x")).select(*self.keys, "__x.*") if rest else rows.select(*self.keys).distinct()
        return self._append(one, "put")

    def delete(self, keys: DataFrame) -> int:
        """Deletes the rows of the keys; keys that are not there change nothing. Returns the version."""
        return self._append(self._among(self.read().select(*self.keys), keys), "delete")

    def delete_where(self, condition: Column | str) -> int:
        """Deletes the rows for which a condition holds, such as those older than a time to live. Returns the version."""
        return self._append(self.read().where(condition).select(*self.keys), "delete")

    def _among(self, rows: DataFrame, keys: DataFrame) -> DataFrame:
        k = keys.select(*[F.col(c).alias(f"__{c}") for c in self.keys]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in self.keys])
        return rows.join(k, same, "left_semi")

    def clear(self) -> int:
        """Empties the store; no row is written. Returns the version."""
        fs, at = self._fs()
        return self._publish(lambda to, _: fs.mkdirs(at(to)), ".clear")

    def read(self, version: int | None = None) -> DataFrame:
        """The store as of a version (the newest by default): the last change of each key after the last clearing or base.

        A version before the oldest base cannot be read any more: ValueError.
        """
        found, at = self._listed(), self.version() if version is None else version
        base = max([b for b in found["base"] if b <= at], default=None)
        if base is None and found["base"]:
            raise ValueError(f"version {at} was compacted away")
        floor = max([0 if base is None else base, *[c for c in found["clear"] if c <= at]])
        paths = [f"{self.path}/base={base}"] if base is not None and base == floor else []
        paths += [f"{self.path}/v={n}" for n in found["rows"] if floor < n <= at]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self._stored).parquet(*paths)
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rows.columns), "version").alias("__x")).select("__x.*")
        return last.where("op = 'put'").select(*[f.name for f in self.schema.fields])

    def compact(self) -> int:
        """Writes the newest state as a base and deletes what came before it. Returns its version."""
        fs, at = self._fs()
        n, found = self.version(), self._listed()
        if n not in found["base"]:
            made = f"{self.path}/.making-{uuid.uuid4().hex}"
            self.read(n).withColumns({"op": F.lit("put"), "version": F.lit(n).cast("long")}).write.parquet(made)
            fs.rename(at(made), at(f"{self.path}/base={n}"))
        for kind, name in (("rows", "v={}"), ("clear", "v={}.clear"), ("base", "base={}")):
            for old in found[kind]:
                if old < n or kind != "base" and old == n:
                    fs.delete(at(f"{self.path}/{name.format(old)}"), True)
        return n
