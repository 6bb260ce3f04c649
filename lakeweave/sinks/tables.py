"""Layer tables and the load modes.

A ``Lakehouse`` owns one root folder (by default under the shared folder named by
``spark.checkpoint.dir``) with one catalog database per layer. Tables are external
Parquet tables whose data lives under that root, so every write is visible to all
executors and survives the loss of any of them. Readers name a view; the view shows one
version, an external table with a name of its own. A version's partitions may lie in folders of
earlier loads: a load writes only what it replaces.

Load modes (each but ``append`` stages, checks, registers a new version and then swaps the view once, so
readers see all of a load or nothing of it, and readers opened before keep their rows):
  full_refresh       everything is replaced; the schema follows the new rows
  replace_partition  exactly one partition tuple is replaced; an empty slice clears it
  insert_overwrite   the partitions present in the incoming rows are replaced, however many
  append             files are added to the version in place (re-running duplicates rows)

The last three raise if the rows' columns are not exactly the table's.

``expect`` names row conditions that no row may meet; they are counted by the write itself
(``DataFrame.observe``), so checking them costs no second scan. ``checks`` are functions of the staged
rows, for what a single row can't tell.

Each version leaves one ledger file with its time and its partitions' folders. ``expire`` drops
superseded versions and deletes the folders that no version left names, those of failed loads too.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeweave.functions.paths import hive_path, partition_values
from lakeweave.session import shared_root
from lakeweave.sinks.folders import Folders

LAYERS = ("temp", "raw", "cleansed", "curated", "reporting")
VERSION = "lakeweave.version"  # property of a table's view: the version it shows
_LEDGER = "_versions"  # folder beside a table's data, one file a version
_LEDGER_SCHEMA = "version string, published_at timestamp, spec string, location string"
_SPECS = 200  # partitions registered by one statement

Check = Callable[[DataFrame], None]


class RejectedLoad(ValueError):
    """Rows that a load's ``expect`` forbids; nothing was published."""


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str):
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def _lit_sql(v) -> str:
    if v is None:
        return "NULL"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec_sql(spec: str) -> str:
    """PARTITION clause of a folder name ``k=v/...``."""
    return "PARTITION (" + ", ".join(f"`{k}` = {_lit_sql(v)}" for k, v in partition_values(spec).items()) + ")"


class Lakehouse:
    def __init__(self, spark: SparkSession, root: str | None = None, namespace: str = ""):
        self.spark = spark
        self.root = (root or f"{shared_root(spark)}/lakehouse").rstrip("/")
        self.namespace = namespace
        self._databases: set[str] = set()
        self.counted: dict[str, dict[str, int]] = {}  # by layer.table: rows of the last load, and of each condition of its ``expect``

    @staticmethod
    def scratch(spark: SparkSession) -> "Lakehouse":
        """A private lakehouse (own folder, own database names) for one run or test."""
        tag = uuid.uuid4().hex[:10]
        return Lakehouse(spark, f"{shared_root(spark)}/lakeweave/lh-{tag}", namespace=f"lw{tag}_")

    # naming -----------------------------------------------------------------------
    def database(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        db = f"{self.namespace}{layer}"
        if db not in self._databases:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{self.root}/{layer}'")
            self._databases.add(db)
        return db

    def name(self, layer: str, table: str) -> str:
        return f"`{self.database(layer)}`.`{table}`"

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database(layer)}.{table}")

    def _new_location(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}/v-{uuid.uuid4().hex[:12]}"

    def version(self, layer: str, table: str) -> str | None:
        """Catalog name of the version that ``table`` shows now; None if there is none yet."""
        version = self._version_id(layer, table)
        return version and self.name(layer, version)

    def _version_id(self, layer: str, table: str) -> str | None:
        if not self.exists(layer, table):
            return None
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(layer, table)}").collect()
        named = {r["key"]: r["value"] for r in found}
        if VERSION not in named:
            raise ValueError(f"{layer}.{table} is a view of another table and takes no rows")
        return named[VERSION]

    # versions -----------------------------------------------------------------------
    def _folder(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _ledger(self, layer: str, table: str, version: str = "*") -> str:
        return f"{self._folder(layer, table)}/{_LEDGER}/{version}.json"

    def _publish(
        self, layer: str, table: str, loc: str, like: DataFrame, partition_by: Sequence[str], found: bool, kept: Mapping[str, str]
    ) -> None:
        """Register a version of the partitions under ``loc`` (``found``) and the ``kept`` folders by partition; show it.

        Partitions that are both under ``loc`` and kept are those under ``loc``. Replacing the
        view is one catalog call and comes last.
        """
        version = f"{table}__{uuid.uuid4().hex[:12]}"
        name = self.name(layer, version)
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields)
        part = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
        self.spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet{part} LOCATION '{loc}'")
        folders: dict[str, str] = {}
        if partition_by:
            if found:
                self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
                folders = {spec: f"{loc}/{spec}" for spec in self._specs(name)}
            kept = {spec: where for spec, where in kept.items() if spec not in folders}
            specs = [f"{_spec_sql(spec)} LOCATION {_lit_sql(where)}" for spec, where in kept.items()]
            for i in range(0, len(specs), _SPECS):
                self.spark.sql(f"ALTER TABLE {name} ADD {' '.join(specs[i : i + _SPECS])}")
            folders |= kept
        self._write_ledger(layer, table, version, datetime.now(timezone.utc), loc, folders)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(layer, table)} TBLPROPERTIES ('{VERSION}' = '{version}') AS SELECT * FROM {name}"
        )

    def _specs(self, version: str) -> list[str]:
        """Folder names (``k=v/...``) of the partitions of a version, from the catalog."""
        return [r[0] for r in self.spark.sql(f"SHOW PARTITIONS {version}").collect()]

    def _write_ledger(self, layer: str, table: str, version: str, at: datetime, loc: str, folders: Mapping[str, str]) -> None:
        rows = [{"version": version, "published_at": at.isoformat(), "spec": s, "location": w} for s, w in {None: loc, **folders}.items()]
        Folders(self.spark).write_text(self._ledger(layer, table, version), "".join(json.dumps(r) + "\n" for r in rows))

    def ledger(self, layer: str, table: str, version: str = "*") -> DataFrame:
        """(version, published_at, spec, location): a row for each version (null ``spec``) and each of its partitions."""
        return self.spark.read.schema(_LEDGER_SCHEMA).json(self._ledger(layer, table, version))

    def _locations(self, layer: str, table: str) -> dict[str, str]:
        """Folder of every partition of the version shown; as many rows as the catalog has partitions."""
        version = self._version_id(layer, table)
        if version is None:
            return {}
        return {r["spec"]: r["location"] for r in self.ledger(layer, table, version).where("spec IS NOT NULL").collect()}

    def partitions(self, layer: str, table: str) -> DataFrame:
        """(spec, location) of the version shown: catalog metadata, no data is read."""
        version = self._version_id(layer, table)
        if version is None:
            return self.spark.createDataFrame([], "spec string, location string")
        return self.ledger(layer, table, version).where("spec IS NOT NULL").select("spec", "location")

    def expire(self, layer: str, table: str, keep: int = 1, older_than: timedelta = timedelta(days=1)) -> list[str]:
        """Drop versions that are neither shown, among the ``keep`` latest, nor younger than ``older_than``; returns them.

        Then folders go that no version left refers to and that are as old: those of dropped versions and of
        loads that failed. ``older_than`` has to outlast the longest load and the longest reader.
        """
        if not self.exists(layer, table):
            return []
        shown, limit = self._version_id(layer, table), datetime.now(timezone.utc) - older_than
        rows = self.ledger(layer, table)
        times = rows.where("spec IS NULL").select("version", F.unix_micros("published_at").alias("at")).collect()
        order = sorted(times, key=lambda r: (r["at"], r["version"]), reverse=True)
        spare = {shown, *(r["version"] for r in order[:keep])}
        gone = [r["version"] for r in order if r["version"] not in spare and r["at"] <= limit.timestamp() * 1e6]
        left = rows.where(~F.col("version").isin(gone)) if gone else rows
        # a partitioned version needs its partitions' folders, not all that lies in its own
        needed = left.groupBy("version").agg(F.collect_set(F.when(F.col("spec").isNotNull(), F.col("location"))).alias("w"), F.max("location").alias("own"))
        used = {w for r in needed.collect() for w in r["w"] or [r["own"]]}
        folders, top = Folders(self.spark), self._folder(layer, table)
        for version in gone:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, version)}")
            folders.delete(self._ledger(layer, table, version))
        above = {w.rsplit("/", i)[0] for w in used for i in range(1, w[len(top) :].count("/"))}

        def sweep(path: str) -> None:
            for child, changed in folders.children(path):
                if child in above:
                    sweep(child)
                elif child not in used and child != f"{top}/{_LEDGER}" and changed <= limit.timestamp() * 1000:
                    folders.delete(child)

        sweep(top)
        return gone

    # K2 / K6: create with the staging schema if missing ----------------------------
    def ensure_table(self, layer: str, table: str, like: DataFrame, partition_by: Sequence[str] = ()) -> str:
        """Name of the version to write into. A missing table is created empty with
        ``like``'s schema (DDL only, no job); an existing one must have exactly its columns."""
        version = self.version(layer, table)
        if version is None:
            cols = [c for c in like.columns if c not in partition_by] + list(partition_by)
            self._publish(layer, table, self._new_location(layer, table), like.select(*cols), partition_by, False, {})
            return self.version(layer, table)
        self._as_table(layer, table, like)
        return version

    def _as_table(self, layer: str, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """``df`` with the columns of the table in its order and types; its own, partition columns last, if there is no table."""
        version = self.version(layer, table)
        if version is None:
            return df.select(*[c for c in df.columns if c not in partition_by], *partition_by)
        has, gets = ({c.lower(): c for c in columns} for columns in (self.spark.table(version).columns, df.columns))
        if has.keys() != gets.keys():
            extra = [gets[c] for c in gets.keys() - has.keys()]
            missing = [has[c] for c in has.keys() - gets.keys()]
            raise ValueError(f"{layer}.{table}: columns {sorted(extra)} are not in the table, {sorted(missing)} are not in the rows")
        return df.to(self.spark.table(version).schema)

    # staging --------------------------------------------------------------------------
    @contextmanager
    def _staged(self, layer: str, table: str):
        """A new folder for one load; deleted if the load fails."""
        loc = self._new_location(layer, table)
        try:
            yield loc
        except BaseException:
            Folders(self.spark).delete(loc)
            raise

    def _write(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        loc: str,
        partition_by: Sequence[str],
        expect: Mapping[str, str],
        strict: bool = True,
        leave_out: Sequence[str] = (),
    ) -> None:
        """Write ``df`` (but for ``leave_out``), counting its rows and those that meet each condition of ``expect`` on the way."""
        names = list(expect)
        if names:
            seen = Observation()
            counts = [F.count_if(F.coalesce(F.expr(expect[n]), F.lit(False))).alias(f"c{i}") for i, n in enumerate(names)]
            df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
        df = df.drop(*leave_out)
        df.write.partitionBy(*partition_by).parquet(loc) if partition_by else df.write.parquet(loc)
        if names:
            got = seen.get
            self.counted[f"{layer}.{table}"] = {"rows": got["rows"], **{n: got[f"c{i}"] for i, n in enumerate(names)}}
            bad = {n: got[f"c{i}"] for i, n in enumerate(names) if got[f"c{i}"]}
            if bad and strict:
                raise RejectedLoad(f"{layer}.{table}: " + "; ".join(f"{n}: {k} rows" for n, k in bad.items()))

    def _check(self, df: DataFrame, loc: str, checks: Sequence[Check]) -> None:
        for check in checks:
            check(self.spark.read.schema(df.schema).parquet(loc))

    # K1 + K3 (+K5): full refresh ---------------------------------------------------
    def full_refresh(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        checks: Sequence[Check] = (),
        expect: Mapping[str, str] | None = None,
        strict: bool = True,
    ) -> DataFrame:
        """Build the new version in its own folder, check it, then publish.

        The new version is a catalog table of its own, with ``df``'s columns and its
        partitions recovered (metadata only). With ``strict`` off, rows that ``expect`` forbids are
        only counted (``counted``).
        """
        df = df.select(*[c for c in df.columns if c not in partition_by], *partition_by)
        with self._staged(layer, table) as loc:
            self._write(layer, table, df, loc, partition_by, expect or {}, strict)
            self._check(df, loc, checks)
            self._publish(layer, table, loc, df, partition_by, True, {})
        return self.table(layer, table)

    # K1 + K2 + K4: partition replace ---------------------------------------------
    def replace_partition(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        partition: dict[str, object],
        checks: Sequence[Check] = (),
        expect: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """Replace exactly one partition tuple with ``df``'s rows; a None value is the partition of NULL.

        The slice is written once; the new version takes all other partitions' folders as they
        are. Rows outside the tuple fail the write; an empty ``df`` clears the partition;
        re-running is idempotent.
        """
        keys = list(partition)
        df = self._as_table(layer, table, df, keys)
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        # an empty text has the folder of NULL, as in Spark's own writes
        values = {k: None if v is None or v == "" else F.lit(v).cast(kinds[k]) for k, v in partition.items()}
        here = F.lit(True)
        for k, v in values.items():
            own = F.when(F.col(k).cast("string") != "", F.col(k))
            here &= own.isNull() if v is None else own.eqNullSafe(v)
        err = F.raise_error(F.lit(f"row outside partition {partition}"))
        # the guard rides on a written column, so it is evaluated by the write itself
        first = next(c for c in df.columns if c not in keys)
        named = [F.lit(None).cast("string") if v is None else v.cast("string") for v in values.values()]
        spec = hive_path("", keys=dict(zip(keys, self.spark.range(1).select(*named).first())))[1:]
        with self._staged(layer, table) as loc:
            guarded = df.withColumn(first, F.when(here, F.col(first)).otherwise(err))
            self._write(layer, table, guarded, f"{loc}/{spec}", [], expect or {}, leave_out=keys)
            self._check(df, loc, checks)
            kept = self._locations(layer, table) | {spec: f"{loc}/{spec}"}
            self._publish(layer, table, loc, df, keys, False, kept)
        return self.table(layer, table)

    # K11 + K12: incremental insert overwrite ----------------------------------------
    def insert_overwrite(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        partition_by: Sequence[str],
        order_by: Sequence[str] = (),
        checks: Sequence[Check] = (),
        expect: Mapping[str, str] | None = None,
        strict: bool = True,
    ) -> DataFrame:
        """Replace only the partitions present in ``df``, all at once; the first run creates the table.

        The rows are written to a folder of the load and checked there. The new version has the
        partitions found in it and, for all others, the folders of the version shown so far. A load
        without rows changes nothing.

        Rows are rebalanced by partition value, so the number of files follows the data's
        size and not tasks x partitions; adaptive execution splits a hot value over several
        tasks. Each task sorts by (partition, order_by), so every file is clustered by the
        sort key and Parquet row-group statistics prune.
        """
        df = self._as_table(layer, table, df, partition_by)
        out = self._rebalanced(df, partition_by).sortWithinPartitions(*partition_by, *order_by)
        with self._staged(layer, table) as loc:
            self._write(layer, table, out, loc, partition_by, expect or {}, strict)
            self._check(df, loc, checks)
            self._publish(layer, table, loc, df, partition_by, True, self._locations(layer, table))
        return self.table(layer, table)

    @staticmethod
    def _rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
        return df.hint("rebalance", *partition_by) if partition_by else df

    # K7 / K8 -------------------------------------------------------------------------
    def append(self, layer: str, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Add ``df``'s rows to the version shown; new partitions get folders of their own in it."""
        name = self.ensure_table(layer, table, df, partition_by)
        out = self._rebalanced(self._as_table(layer, table, df), partition_by)
        out.write.mode("append").insertInto(name.replace("`", ""))
        self.spark.catalog.refreshTable(name.replace("`", ""))
        if partition_by:
            version, known = self._version_id(layer, table), self._locations(layer, table)
            own = self.ledger(layer, table, version).where("spec IS NULL").first()
            added = {spec: f"{own['location']}/{spec}" for spec in self._specs(name) if spec not in known}
            if added:
                at = own["published_at"].astimezone(timezone.utc)
                self._write_ledger(layer, table, version, at, own["location"], known | added)
        return self.table(layer, table)

    def load(self, layer: str, table: str, df: DataFrame, disposition: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """API write disposition: ``replace`` (full refresh) or ``append``."""
        if disposition == "replace":
            return self.full_refresh(layer, table, df, partition_by)
        if disposition == "append":
            return self.append(layer, table, df, partition_by)
        raise ValueError(f"unknown write disposition {disposition!r}")

    # K10: view ------------------------------------------------------------------------
    def view(self, layer: str, name: str, source_layer: str, source_table: str, columns: str = "*") -> DataFrame:
        """Persistent catalog view over a persisted table (``SELECT <columns> FROM ...``).

        Views bind late: a refresh of the source table shows through without touching
        the view.
        """
        src = self.name(source_layer, source_table)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, name)} AS SELECT {columns} FROM {src}")
        return self.table(layer, name)

    # K14: copy with data, skipped if the target exists ------------------------------
    def copy_table(self, src_layer: str, src: str, dst_layer: str, dst: str) -> DataFrame:
        if not self.exists(dst_layer, dst):
            self.full_refresh(dst_layer, dst, self.table(src_layer, src))
        return self.table(dst_layer, dst)
