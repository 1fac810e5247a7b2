"""Table storage: a warehouse is a folder of Parquet tables and a commit log.

A table's rows lie in folders ``<root>/<table>/load=<name>``. Which of them
count is said by the latest version of the log (``sinks.commits``); readers
look at no others. ``begin`` opens a load:

* ``replace`` — rebuild a table (staging ``tmp_*``, clean ``tb_*``, the orders
  snapshot): the rows are written aside and the table points to them later;
* ``append`` — add rows to a star table, in a folder of their own;
* ``ensure`` — create a table only where absent; ``drop`` — leave it out;
* ``commit`` — all of this becomes visible by one put-if-absent of a log entry,
  or, if another load committed meanwhile, none of it (``ConcurrentLoad``).

A load that breaks off leaves folders that no version lists; ``vacuum`` removes
those and what later versions no longer list.

The fact and the orders snapshot are bucketed by ``order_id``, with as many
buckets as the session shuffles into when the table is made, so they are joined
and grouped by order without moving either, and a batch of orders is sent to
the buckets of the stored fact, not the fact to the batch.

Frames are read through an external table of the session catalog, in a database
of this root alone, by the list of committed folders: a partition filter that
never lists the rest. ``register`` exposes the tables as views under a database
name of the user's choice (default ``analytics``) and makes it the current one,
so unqualified names resolve there.

The root must be storage that every executor sees, with a rename that refuses
an existing target (HDFS and the like, or a shared mount).
"""

from __future__ import annotations

import hashlib
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import schemas
from starmart.plans.star import CleanTables, Star
from starmart.sinks.commits import CommitLog, ConcurrentLoad, Folder, State, Table
from starmart.sinks.storage import children, delete_path, path_exists, qualified

__all__ = ["ConcurrentLoad", "Load", "Warehouse", "delete_path", "path_exists"]

LOAD = "load"  # the partition column that names a folder
#: By application and external table: folders that are partitions there already. A folder never changes.
_KNOWN: dict[tuple[str, str], set[str]] = {}


class Warehouse:
    """Parquet tables below one root folder."""

    CLEAN_TABLES = ("tb_customers", "tb_sellers", "tb_products", "tb_orders", "tb_order_items")
    STAGING_TABLES = ("tmp_orders", "tmp_items", "tmp_customers", "tmp_products", "tmp_sellers")
    SNAPSHOT = "orders_snapshot"
    BUCKETED = {"fact_sales": "order_id", SNAPSHOT: "order_id"}

    def __init__(self, spark: SparkSession, root: str, database: str = "analytics", buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        self.buckets = buckets
        self.log = CommitLog(spark, self.root)
        self._own = "starmart_" + hashlib.md5(qualified(spark, self.root).encode()).hexdigest()[:16]

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def state(self) -> State:
        return self.log.latest()

    def exists(self, table: str) -> bool:
        return table in self.state().tables

    def tables(self) -> list[str]:
        return sorted(self.state().tables)

    # ---- writes ----------------------------------------------------------
    def begin(self) -> Load:
        return Load(self)

    def overwrite(self, table: str, df: DataFrame) -> DataFrame:
        """Replace a table, in a load of its own, and return a frame that reads it back."""
        with self.begin() as load:
            out = load.replace(table, df)
        return out

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows to a table, in a load of their own."""
        with self.begin() as load:
            load.append(table, df)

    def compact(self, table: str) -> DataFrame:
        """Rewrite a table's folders as one."""
        with self.begin() as load:
            return load.replace(table, load.read(table))

    def drop(self, table: str) -> bool:
        """Remove this warehouse's table; True when something was removed.

        A catalog entry goes only if it is in the warehouse's database and a
        view of this root's table: others may have a table of that name.
        """
        found = self.exists(table)
        if found:
            with self.begin() as load:
                load.drop(table)
        self._forget(table)
        return delete_path(self.spark, self.path(table)) or found

    def drop_intermediates(self) -> list[str]:
        """Remove the clean and staging layers, in one version; the star and snapshot stay."""
        names = [t for t in (*self.CLEAN_TABLES, *self.STAGING_TABLES) if self.exists(t)]
        if names:
            with self.begin() as load:
                for t in names:
                    load.drop(t)
        for t in names:
            self._forget(t)
            delete_path(self.spark, self.path(t))
        return names

    def vacuum(self, older_than_hours: float = 24.0) -> list[str]:
        """Remove folders that the latest version does not list and that are older than any running load."""
        state, gone = self.state(), []
        until = (time.time() - older_than_hours * 3600) * 1000
        for table, is_folder, _ in children(self.spark, self.root):
            if not is_folder or table.startswith(("_", ".")):
                continue
            listed = {f.name for f in state.tables[table].folders} if table in state.tables else set()
            for name, _, changed in children(self.spark, self.path(table)):
                if name.startswith(f"{LOAD}=") and name.split("=", 1)[1] not in listed and changed <= until:
                    delete_path(self.spark, f"{self.path(table)}/{name}")
                    gone.append(f"{table}/{name}")
        self.log.forget_before(state.version)
        return sorted(gone)

    # ---- reads -----------------------------------------------------------
    def frame(self, name: str, table: Table, folders: tuple[Folder, ...] | None = None) -> DataFrame:
        """The rows of some of a table's folders (all)."""
        folders = table.folders if folders is None else folders
        if not folders:
            return self.spark.createDataFrame([], table.struct)
        source = self._external(name, table, folders)
        listed = F.col(LOAD).isin([f.name for f in folders])
        return self.spark.table(source).where(listed).select(*[F.col(f"`{c}`") for c in table.struct.fieldNames()])

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        found = self.state().tables.get(table)
        if found is None:
            if schema is None:
                raise FileNotFoundError(f"no table {table} in {self.root}")
            return self.spark.createDataFrame([], schema)
        return self.frame(table, found)

    def read_star_tables(self) -> dict[str, DataFrame]:
        return {n: self.read(n, s) for n, s in schemas.STAR_SCHEMAS.items()}

    def read_star(self) -> Star:
        state = self.state()
        names = (*schemas.STAR_ORDER, self.SNAPSHOT)
        return Star(**{n: self.frame(n, state.tables[n]) for n in names})

    def read_clean(self) -> CleanTables:
        state = self.state()
        return CleanTables(*[self.frame(n, state.tables[n]) for n in self.CLEAN_TABLES])

    # ---- catalog ---------------------------------------------------------
    def _external(self, name: str, table: Table, folders: tuple[Folder, ...]) -> str:
        """The external table that reads ``name``, with these folders as partitions."""
        shape = hashlib.md5(f"{table.schema}/{table.bucket_by}/{table.buckets}".encode()).hexdigest()[:8]
        source = f"`{self._own}`.`{name}_{shape}`"
        known = _KNOWN.setdefault((self.spark.sparkContext.applicationId, source), set())
        folders = tuple(f for f in folders if f.name not in known)
        if not folders:
            return source
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self._own}` LOCATION '{self.root}/_catalog'")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.struct.fields)
        clustered = f"CLUSTERED BY (`{table.bucket_by}`) INTO {table.buckets} BUCKETS" if table.bucket_by else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {source} ({columns}, `{LOAD}` string) USING parquet "
            f"PARTITIONED BY (`{LOAD}`) {clustered} LOCATION '{self.path(name)}'"
        )
        parts = " ".join(f"PARTITION (`{LOAD}`='{f.name}')" for f in folders)
        self.spark.sql(f"ALTER TABLE {source} ADD IF NOT EXISTS {parts}")
        known |= {f.name for f in folders}
        return source

    def _entry(self, database: str, name: str) -> dict[str, str] | None:
        """What the catalog says of ``database.name``."""
        if not self.spark.catalog.databaseExists(database) or not self.spark.catalog.tableExists(f"`{database}`.`{name}`"):
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED `{database}`.`{name}`").collect()
        return {r["col_name"]: r["data_type"] for r in rows}

    def _forget(self, table: str) -> None:
        entry = self._entry(self.database, table)
        if entry and entry.get("Type") == "VIEW" and self._own in entry.get("View Text", ""):
            self.spark.sql(f"DROP VIEW `{self.database}`.`{table}`")

    def register(self, database: str = "analytics", use: bool = True) -> list[str]:
        """Expose every table as the view ``database.table``, as of the latest version."""
        self.database = database
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.root}/_catalog'")
        state = self.state()
        for name, table in sorted(state.tables.items()):
            entry = self._entry(database, name)
            if entry and entry.get("Type") != "VIEW":
                raise ValueError(f"{database}.{name} is a table of its own; it is left alone")
            if table.folders:
                columns = ", ".join(f"`{c}`" for c in table.struct.fieldNames())
                listed = ", ".join(f"'{f.name}'" for f in table.folders)
                body = f"{columns} FROM {self._external(name, table, table.folders)} WHERE `{LOAD}` IN ({listed})"
            else:
                nulls = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in table.struct.fields]
                body = f"{', '.join(nulls)} WHERE '{self._own}' IS NULL"
            self.spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT {body}")
        if use:
            self.spark.catalog.setCurrentDatabase(database)
        return sorted(state.tables)


@dataclass(frozen=True)
class Delta:
    """Rows that a load adds to a table, and the folders it found."""

    rows: DataFrame
    had: tuple[Folder, ...]


class Load:
    """What one load writes, on the version it began from. As a context it commits, or aborts on an error."""

    def __init__(self, wh: Warehouse):
        self.wh, self.spark = wh, wh.spark
        self.before = wh.state()
        self.tables = dict(self.before.tables)
        self.written: list[tuple[str, Folder]] = []
        self.done = False

    def __enter__(self) -> Load:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None and not self.done:
            self.commit()
        elif kind is not None:
            self.abort()

    def _shape(self, name: str, schema: T.StructType) -> Table:
        by, old = self.wh.BUCKETED.get(name), self.before.tables.get(name)
        n = old.buckets if old and by else self.wh.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return Table(schema.json(), by, n if by else 0)

    def _write(self, name: str, shape: Table, df: DataFrame) -> Folder:
        """One folder of rows, invisible until the commit lists it."""
        folder = Folder(f"{int(time.time()):011d}-{uuid.uuid4().hex}", 0)
        path = f"{self.wh.path(name)}/{LOAD}={folder.name}"
        self.written.append((name, folder))
        df = df.select(*[F.col(f"`{c}`") for c in shape.struct.fieldNames()])
        if shape.bucket_by:
            # A table of its own, so the job's temporary files are in this folder alone.
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.wh._own}` LOCATION '{self.wh.root}/_catalog'")
            own = f"`{self.wh._own}`.`write_{uuid.uuid4().hex}`"
            dealt = df.repartition(shape.buckets, shape.bucket_by)
            dealt.write.bucketBy(shape.buckets, shape.bucket_by).option("path", path).format("parquet").saveAsTable(own)
            self.spark.sql(f"DROP TABLE {own}")
        else:
            df.write.parquet(path)
        # Counts and key range of what is stored; plain counts come from the footers.
        back, key = self.spark.read.schema(shape.struct).parquet(path), schemas.SURROGATE_KEYS.get(name)
        null, by = F.lit(None), shape.bucket_by
        facts = [F.count(F.lit(1))]
        facts += [F.min(key), F.max(key)] if key else [F.max(null), F.max(null)]
        facts += [F.min(by), F.max(by)] if by else []
        return Folder(folder.name, *back.agg(*facts).first())

    def read(self, name: str, within: tuple[str, str] | None = None) -> DataFrame:
        """The table as it will be; ``within`` leaves out folders that hold no bucket key between these bounds."""
        table = self.tables[name]
        folders = table.folders if within is None else tuple(f for f in table.folders if f.meets(*within))
        return self.wh.frame(name, table, folders)

    def ensure(self, name: str, schema: T.StructType) -> None:
        if name not in self.tables:
            self.tables[name] = self._shape(name, schema)

    def append(self, name: str, df: DataFrame) -> DataFrame:
        """Write rows to add; returns them as stored."""
        shape = self.tables.get(name) or self._shape(name, df.schema)
        folder = self._write(name, shape, df)
        self.tables[name] = shape.plus(folder) if folder.rows else shape
        return self.wh.frame(name, shape, (folder,) if folder.rows else ())

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table anew; the one it replaces stays until the commit."""
        shape = self._shape(name, df.schema)
        folder = self._write(name, shape, df)
        self.tables[name] = shape.plus(folder) if folder.rows else shape
        return self.read(name)

    def drop(self, name: str) -> None:
        self.tables.pop(name, None)

    def added(self, name: str) -> int:
        """Rows that this load adds to a table."""
        old = self.before.tables.get(name)
        return self.tables[name].rows - (old.rows if old else 0)

    def deltas(self, names) -> dict[str, Delta]:
        """For each table what this load adds, and the folders that were there."""
        out = {}
        for name in names:
            old = self.before.tables.get(name)
            had = old.folders if old else ()
            new = tuple(f for f in self.tables[name].folders if f not in had)
            out[name] = Delta(self.wh.frame(name, self.tables[name], new), had)
        return out

    def _sweep(self, keep: dict[str, Table]) -> None:
        listed = {(n, f.name) for n, t in keep.items() for f in t.folders}
        for name, folder in self.written:
            if (name, folder.name) not in listed:
                delete_path(self.spark, f"{self.wh.path(name)}/{LOAD}={folder.name}")

    def commit(self) -> State:
        """Make everything visible at once, or raise ``ConcurrentLoad`` and publish nothing."""
        after = State(self.before.version + 1, self.tables)
        try:
            self.wh.log.commit(after)
        except ConcurrentLoad:
            self.abort()
            raise
        self.done = True
        self._sweep(after.tables)
        return after

    def abort(self) -> None:
        """Remove what was written; no version lists it."""
        if not self.done:
            self.done = True
            self._sweep({})
