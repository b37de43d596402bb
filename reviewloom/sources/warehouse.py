"""Warehouse tables: each name is a view over the newest version of a parquet table.

A rewrite fills a new version and then points the view at it, so readers see the old rows or the new
ones and a lost executor or a failed job leaves the old version in place.

Feature tables are partitioned by a hash bucket of the review id, which the view hides. Rows of some ids are replaced
by Spark's dynamic partition overwrite: only the buckets of those ids are read and written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.operators.keys import replace_by_key
from reviewloom.schemas import FEATURE_TABLES
from reviewloom.session import materialise, scratch_path

KEY = "Review_ID"
BUCKET = "key_bucket"
# Buckets of a feature table: a rewrite for few ids costs about one bucket an id, so large tables want thousands.
BUCKETS = 16


class Warehouse:
    """``buckets`` is fixed for the life of a database."""

    def __init__(self, spark: SparkSession, database: str = "default", location: str | None = None, buckets: int = BUCKETS):
        self.spark = spark
        self.database = database
        self.buckets = buckets
        # a session of its own for the setting: several threads may replace rows of several tables at once
        self._writer = spark.newSession()
        self._writer.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")

    def table(self, name: str) -> DataFrame:
        # another session (a stream has its own) may have added files since this one listed them
        self.spark.catalog.refreshTable(f"{self.database}.{name}")
        return self.spark.table(f"{self.database}.{name}")

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{name}")

    def _versions(self, name: str) -> list[int]:
        prefix = f"{name}__v"
        tables = self.spark.catalog.listTables(self.database, f"{prefix}*")
        return sorted(int(t.name[len(prefix) :]) for t in tables if t.name.startswith(prefix))

    def _shown(self, name: str) -> int | None:
        """The version behind the view. A write that failed may have left a higher one, which nobody reads."""
        if not self.exists(name):
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.database}.{name}").where("col_name = 'View Text'").collect()
        return int(rows[0].data_type.rsplit("__v", 1)[1])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(KEY), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def _insert(self, name: str, rows: DataFrame) -> None:
        """Add rows to a physical table in its column order; a bucketed table gets few files a bucket."""
        columns = self.spark.table(name).columns
        if BUCKET in columns:
            rows = rows.select(*columns[:-1], self._bucket()).hint("rebalance", BUCKET)
        rows.select(*columns).write.insertInto(name)

    def overwrite(self, name: str, rows: DataFrame | None, ddl: str | None = None) -> None:
        """Replace the table by ``rows``, which may read the table itself. One older version is kept.

        With ``ddl`` the table has the declared types; ``rows`` of None leaves it empty.
        """
        old, shown = self._versions(name), self._shown(name)
        version = (old[-1] if old else 0) + 1
        full = f"{self.database}.{name}__v{version}"
        if ddl:
            bucketed = name in FEATURE_TABLES
            self.spark.sql(f"CREATE TABLE {full} ({ddl}{f', {BUCKET} INT' if bucketed else ''}) USING parquet{f' PARTITIONED BY ({BUCKET})' if bucketed else ''}")
            if rows is not None:
                self._insert(full, rows)
        else:
            rows.write.format("parquet").saveAsTable(full)
        shown_columns = ", ".join(f"`{c}`" for c in self.spark.table(full).columns if c != BUCKET)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.database}.{name} AS SELECT {shown_columns} FROM {full}")
        # what a failed write left behind goes as well
        for stale in old:
            if stale != shown:
                self.spark.sql(f"DROP TABLE {self.database}.{name}__v{stale}")

    def _current(self, name: str) -> str:
        return f"{self.database}.{name}__v{self._shown(name)}"

    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows in the column order of the table."""
        self._insert(self._current(name), rows)

    def replace_keys(self, name: str, rows: DataFrame, keys: DataFrame) -> list[int]:
        """Give the review ids in ``keys`` the new ``rows`` in a feature table; returns the buckets written.

        Untouched buckets keep their files. The new content of the touched ones is stored before it takes their
        place, which a job that fails half-way leaves as they were; what was written is written again by a repetition.
        """
        full = self._current(name)
        self.spark.catalog.refreshTable(full)
        ids = materialise(keys.select(KEY).distinct(), "keys")
        # at most ``buckets`` numbers reach the driver
        touched = sorted(r[0] for r in ids.select(self._bucket()).distinct().collect())
        if not touched:
            return []
        target = self.spark.table(full)
        old = target.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
        path = scratch_path(self.spark, "replaced")
        replace_by_key(old, rows, ids, KEY).withColumn(BUCKET, self._bucket()).hint("rebalance", BUCKET).write.parquet(path)
        new = self._writer.read.schema(target.schema).parquet(path)
        new.select(*target.columns).write.insertInto(full, overwrite=True)
        filled = {r[0] for r in new.select(BUCKET).distinct().collect()}
        present = {int(r.partition.split("=")[1]) for r in self.spark.sql(f"SHOW PARTITIONS {full}").collect()}
        for bucket in sorted((set(touched) - filled) & present):
            # its last rows are gone, and nothing was written that could take their place
            self.spark.sql(f"ALTER TABLE {full} DROP IF EXISTS PARTITION ({BUCKET}={bucket})")
        self.spark.catalog.refreshTable(full)
        self.spark.catalog.refreshTable(f"{self.database}.{name}")
        return touched

    def create_empty(self, name: str, ddl: str) -> None:
        self.overwrite(name, None, ddl)

    def create_feature_tables(self) -> None:
        """Create or replace the seven empty feature tables."""
        for name, ddl in FEATURE_TABLES.items():
            self.create_empty(name, ddl)
