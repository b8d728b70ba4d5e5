"""Where published tables live: one shared root folder plus the session catalog.

A snapshot is written to a folder of its own and verified there. It becomes a table
of its own, a version; the published name is a view of one version. Publishing
alters the view, which is one catalog call whether or not the schema changes (to
create or replace it would drop it first): a reader sees the old version or the
new one, and a crash leaves either.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import UTC, datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagate import vocabulary as v
from stratagate.session import written

#: Size of a compacted file, and writers of one file each at the same time.
FILE_BYTES = 128 * 1024 * 1024
MOST_WRITERS = 1000


def sql_text(text: str) -> str:
    """Escape a text for a single-quoted SQL literal."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str
    bronze: str = "bronze"
    silver: str = "silver"
    control: str = "controle"
    #: Newest versions of a snapshot to keep when another is published; None: all.
    keep_versions: int | None = None

    def prepare(self) -> Store:
        for schema in (self.bronze, self.silver, self.control):
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
        self.ensure(self.run_log, v.RUN_LOG_DDL, (v.PARTITION_COL, v.PERIOD_COL))
        self.ensure(
            self.quarantine, v.QUARANTINE_DDL, (v.PARTITION_COL, v.PERIOD_COL)
        )
        return self

    @property
    def run_log(self) -> str:
        return f"{self.control}.execucoes"

    @property
    def quarantine(self) -> str:
        return f"{self.control}.quarentena"

    def folder(self, table: str, *parts: str) -> str:
        return posixpath.join(self.root, table.replace(".", "/"), *parts)

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(table)

    # ------------------------------------------------ append-only tables

    def ensure(self, table: str, ddl: str, partition: Iterable[str] = ()) -> None:
        by = f"PARTITIONED BY ({', '.join(partition)})" if partition else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet {by} "
            f"LOCATION '{sql_text(self.folder(table))}'"
        )

    def append(self, table: str, rows: DataFrame) -> None:
        columns = self.spark.table(table).columns
        rows.select(*columns).write.insertInto(table)

    def _files(self, table: str, by: list[str], closed: str) -> DataFrame:
        """Files of the partitions for which ``closed`` holds, from their metadata."""
        rows = self.spark.table(table).where(closed)
        return rows.select(*by, "_metadata.file_path", "_metadata.file_size").distinct()

    def compact(
        self, table: str, by: list[str], closed: str, order: Iterable[str] = (), file_bytes: int = FILE_BYTES
    ) -> int:
        """Rewrite closed partitions beside their readers; return how many changed.

        ``by`` names the partition columns and ``closed`` tells by them which partitions
        get no more rows. All of them are rewritten in one job: one file each, or
        ranges of ``order`` where a file would be too large, so that file statistics
        prune by it. Each is then shown by one catalog call, after its rows were
        counted again; if files came in meanwhile, nothing changes. Old files stay
        for those who read them. Partitions of a NULL are left as they are.
        """
        before = written(self._files(table, by, closed), "files")
        each = before.groupBy(*by).agg(
            F.count(F.lit(1)).alias("_files"), F.ceil(F.sum("file_size") / file_bytes).alias("_wanted")
        )
        due = written(each.where("_files > _wanted").dropna(subset=by), "partitions")
        total = due.agg(F.count(F.lit(1)), F.sum("_wanted"), F.max("_wanted")).first()
        if not total[0]:
            return 0
        folder = self.folder(f"{table}_compacted", uuid4().hex[:12])
        rows = self.spark.table(table).where(closed).join(F.broadcast(due), by).drop("_files")
        order = list(order)
        # the number of partitions in both is small, that of files is not bounded
        single = rows.where("_wanted = 1").drop("_wanted").repartition(min(total[0], MOST_WRITERS), *by)
        single.sortWithinPartitions(*by, *order).write.partitionBy(*by).parquet(f"{folder}/single")
        places = [f"{folder}/single"]
        if total[2] > 1:
            ranged = rows.where("_wanted > 1").drop("_wanted").repartitionByRange(int(total[1]), *by, *order)
            ranged.sortWithinPartitions(*by, *order).write.partitionBy(*by).parquet(f"{folder}/ranged")
            places.append(f"{folder}/ranged")
        counted = self.spark.table(table).where(closed).join(F.broadcast(due), by).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
        for i, place in enumerate(places):
            found = self.spark.read.schema(self.spark.table(table).schema).parquet(place)
            again = found.groupBy(*by).agg(F.count(F.lit(1)).alias("again"), F.lit(i).alias("_place"))
            seen = again if not i else seen.unionByName(again)
        wrong = counted.join(seen, by, "full").where("NOT n <=> again")
        self.spark.catalog.refreshTable(table)
        late = self._files(table, by, closed).exceptAll(before)
        if not wrong.isEmpty() or not late.isEmpty():
            self.discard(folder)
            raise RuntimeError(f"{table}: rows came in while closed partitions were compacted")
        # one row per rewritten partition
        shown = seen.select(*by, "_place").collect()
        for r in shown:
            keys = ", ".join(f"`{c}` = '{sql_text(str(r[c]))}'" for c in by)
            inner = self._partition_path(places[r["_place"]], {c: str(r[c]) for c in by})
            self.spark.sql(f"ALTER TABLE {table} PARTITION ({keys}) SET LOCATION '{sql_text(inner)}'")
        self.spark.catalog.refreshTable(table)
        return len(shown)

    def _partition_path(self, place: str, values: dict[str, str]) -> str:
        names = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        return posixpath.join(place, *[names.getPartitionPathString(c, x) for c, x in values.items()])

    # -------------------------------------------------------- snapshots

    def schema_of(self, table: str) -> list[tuple[str, str]]:
        return self.spark.table(table).dtypes

    def point(
        self,
        table: str,
        folder: str,
        schema: list[tuple[str, str]],
        text: str = "",
        comments: dict[str, str] | None = None,
    ) -> None:
        """Make a written and verified folder the content of ``table``."""
        comments = comments or {}
        version = f"{table}__v{datetime.now(UTC):%Y%m%d%H%M%S%f}_{uuid4().hex[:6]}"
        columns = ", ".join(
            f"`{name}` {kind}" + (f" COMMENT '{sql_text(comments[name])}'" if comments.get(name) else "")
            for name, kind in schema
        )
        self.spark.sql(
            f"CREATE TABLE {version} ({columns}) USING parquet "
            f"LOCATION '{sql_text(folder)}' TBLPROPERTIES ('folder' = '{sql_text(folder)}')"
        )
        if self.exists(table) and not self._is_view(table):
            # a table that an earlier release left under the name; it gives way once
            self.spark.sql(f"DROP TABLE {table}")
        listed = ", ".join(f"`{name}`" for name, _ in schema)
        change = "ALTER" if self.exists(table) else "CREATE"
        self.spark.sql(f"{change} VIEW {table} AS SELECT {listed} FROM {version}")
        if (self.spark.catalog.getTable(table).description or "") != text:
            self.spark.sql(f"ALTER VIEW {table} SET TBLPROPERTIES ('comment' = '{sql_text(text)}')")
        if self.keep_versions is not None:
            self.retire(table, self.keep_versions)

    def _is_view(self, table: str) -> bool:
        return self.spark.catalog.getTable(table).tableType == "VIEW"

    def shown_version(self, table: str) -> str:
        """The version a published name shows."""
        about = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
        return about.where("col_name = 'View Text'").first().data_type.rsplit(" ", 1)[1]

    def version_folder(self, version: str) -> str:
        return self.spark.sql(f"SHOW TBLPROPERTIES {version}").where("key = 'folder'").first()["value"]

    def versions(self, table: str) -> list[str]:
        """Versions of a snapshot, oldest first."""
        schema, name = table.rsplit(".", 1)
        shown = self.spark.sql(f"SHOW TABLES IN {schema} LIKE '{name}__v*'").collect()
        return sorted(f"{schema}.{r.tableName}" for r in shown)

    def retire(self, table: str, keep: int) -> list[str]:
        """Drop all but the newest versions, with their folders; never the one shown."""
        known, shown = self.versions(table), self.shown_version(table)
        old = [x for x in known[: max(0, len(known) - keep)] if x != shown]
        kept = {self.version_folder(x) for x in known if x not in old}
        for version in old:
            folder = self.version_folder(version)
            self.spark.sql(f"DROP TABLE {version}")
            if folder not in kept:
                # a staged version is the well-formed side of its folder
                self.discard(posixpath.dirname(folder) if "=" in posixpath.basename(folder) else folder)
        return old

    def discard(self, folder: str) -> None:
        """Delete a folder of this store that nothing was pointed at."""
        if not folder.startswith(self.root.rstrip("/") + "/"):
            raise ValueError(f"{folder} is not below {self.root}")
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)

    def count_version(self, folder: str, schema: list[tuple[str, str]]) -> int:
        """Rows in a written folder; answered from the file footers."""
        ddl = ", ".join(f"`{name}` {kind}" for name, kind in schema)
        return self.spark.read.schema(ddl).parquet(folder).count()

    # --------------------------------------------------------- comments

    def comment(self, table: str, text: str, columns: dict[str, str]) -> list[str]:
        """Give a published table these comments; return the names that differed.

        Columns change together, by a version of the same folder.
        """
        fields = {f.name: f.metadata.get("comment", "") for f in self.spark.table(table).schema}
        wanted = {n: columns.get(n, told) for n, told in fields.items()}
        differing = [n for n in fields if wanted[n] != fields[n]]
        if (self.spark.catalog.getTable(table).description or "") != text:
            differing.insert(0, table)
        if differing:
            folder = self.version_folder(self.shown_version(table))
            self.point(table, folder, self.schema_of(table), text, wanted)
        return differing
