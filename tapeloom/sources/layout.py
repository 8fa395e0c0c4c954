"""Tables as parquet folders under one root on shared storage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions.columns import Moment, moment
from tapeloom.schemas import TABLES, Table


@dataclass(frozen=True)
class Layout:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def checkpoint(self, query: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{query}"

    def version(self, name: str, version: int) -> str:
        return f"{self.path(name)}/version={version}"


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _folder(spark, path)
    return fs.exists(where)


def versions(spark: SparkSession, layout: Layout, name: str) -> list[int]:
    """Complete versions of a snapshot table, oldest first."""
    where, fs = _folder(spark, layout.path(name))
    if not fs.exists(where):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]
    numbers = [int(n.split("=")[1]) for n in found if n.startswith("version=")]
    return sorted(v for v in numbers if exists(spark, f"{layout.version(name, v)}/_SUCCESS"))


def drop_old_versions(spark: SparkSession, layout: Layout, name: str, keep: int = 3) -> list[int]:
    """Delete all but the newest versions; running readers need `keep` to cover them."""
    old = versions(spark, layout, name)[:-keep]
    for version in old:
        where, fs = _folder(spark, layout.version(name, version))
        fs.delete(where, True)
    return old


def table_exists(spark: SparkSession, layout: Layout, name: str) -> bool:
    if TABLES[name].storage == "snapshots":
        return bool(versions(spark, layout, name))
    return exists(spark, layout.path(name))


def _day(table: Table) -> str:
    return f"{table.day_of}_day"


def _stored_ddl(table: Table) -> str:
    batch = ", batch bigint" if table.storage == "batches" else ""
    day = f", {_day(table)} date" if table.day_of else ""
    return table.ddl + batch + day


def _since(df: DataFrame, table: Table, since: Moment) -> DataFrame:
    """Prune day folders first, then rows."""
    if since is None:
        return df
    if not table.day_of:
        raise ValueError("the table has no time column to prune on")
    start = moment(since)
    return df.where((F.col(_day(table)) >= F.to_date(start)) & (F.col(table.day_of) >= start))


def read_table(
    spark: SparkSession,
    layout: Layout,
    name: str,
    since: Moment = None,
    version: int | None = None,
) -> DataFrame:
    """A table with its declared schema; of a snapshot table the newest version."""
    table = TABLES[name]
    path = layout.path(name)
    if table.storage == "snapshots":
        if version is None:
            known = versions(spark, layout, name)
            if not known:
                raise FileNotFoundError(path)
            version = known[-1]
        path = layout.version(name, version)
    df = spark.read.schema(_stored_ddl(table)).parquet(path)
    return _since(df, table, since).select(*table.columns)


def read_stream(
    spark: SparkSession, layout: Layout, name: str, max_files: int | None = None
) -> DataFrame:
    """A growing table as a stream of its new files, oldest first."""
    table = TABLES[name]
    if table.storage == "snapshots":
        raise ValueError(f"{name} is rewritten as a whole and cannot be streamed")
    reader = spark.readStream.schema(_stored_ddl(table))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(layout.path(name)).select(*table.columns)


def conform(df: DataFrame, name: str) -> DataFrame:
    """The declared columns in declared order and type."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name].schema])


def _write_by_day(df: DataFrame, table: Table, path: str, mode: str, *folders: str) -> None:
    if table.day_of:
        df = df.withColumn(_day(table), F.to_date(table.day_of))
        folders = (*folders, _day(table))
    df.write.mode(mode).partitionBy(*folders).parquet(path)


def write_table(df: DataFrame, layout: Layout, name: str, mode: str = "append") -> None:
    """Append to a bronze or dimension table, or rebuild any table as a whole."""
    table = TABLES[name]
    df = conform(df, name)
    if table.storage == "snapshots":
        write_version(df, layout, name)
    elif table.storage == "append":
        _write_by_day(df, table, layout.path(name), mode)
    elif mode == "overwrite":
        df = df.withColumn("batch", F.lit(0).cast("long"))
        _write_by_day(df, table, layout.path(name), mode, "batch")
    else:
        raise ValueError(f"{name} grows by write_batch")


def write_batch(df: DataFrame, layout: Layout, name: str, batch: int) -> None:
    """Write one micro-batch into its own folder; a retried batch replaces itself."""
    path = f"{layout.path(name)}/batch={batch}"
    _write_by_day(conform(df, name), TABLES[name], path, "overwrite")


def write_version(
    df: DataFrame, layout: Layout, name: str, version: int | None = None, writer: str = "", after: int | None = None
) -> int:
    """Write a complete new version beside the old ones; readers switch once it is whole.

    A version that exists is only replaced by its own writer, which then retries. Without a number, the next one
    is taken, or the one `after` the version that df was made from: it is made aside and refused if another
    writer has begun that version meanwhile.
    """
    if version is None:
        return _write_next_version(df, layout, name, after)
    if exists(df.sparkSession, f"{(path := layout.version(name, version))}/_SUCCESS"):
        made_by = f"{path}/_writer"
        if not exists(df.sparkSession, made_by) or df.sparkSession.read.text(made_by).first()[0] != writer:
            raise RuntimeError(f"version {version} of {name} was made by another writer")
    path = layout.version(name, version)
    conform(df, name).write.mode("overwrite").parquet(path)
    if writer:
        df.sparkSession.createDataFrame([(writer,)], "value string").write.text(f"{path}/_writer")
    return version


def _write_next_version(df: DataFrame, layout: Layout, name: str, after: int | None) -> int:
    spark = df.sparkSession
    known = versions(spark, layout, name) if after is None else [after]
    version = known[-1] + 1 if known else 0
    aside, fs = _folder(spark, f"{layout.path(name)}/_making-{uuid.uuid4().hex}")
    conform(df, name).write.parquet(aside.toString())
    place, _ = _folder(spark, layout.version(name, version))
    if fs.exists(place) or not fs.rename(aside, place):
        fs.delete(aside, True)
        raise RuntimeError(f"version {version} of {name} was made or begun by another writer meanwhile")
    return version


def save_bucketed(
    df: DataFrame, layout: Layout, name: str, key: str = "order_id", buckets: int = 1024
) -> DataFrame:
    """Store a table hash-bucketed and sorted by a key in the session catalog.

    Joins and aggregates on the key between tables with the same bucket count then
    need no shuffle. Point lookups by key read one bucket.
    """
    spark = df.sparkSession
    (
        conform(df, name)
        .repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", f"{layout.path(name)}_by_{key}")
        .saveAsTable(f"{name}_by_{key}")
    )
    return spark.table(f"{name}_by_{key}")


def append_rows(
    spark: SparkSession, layout: Layout, name: str, rows: Iterable[Mapping[str, object]]
) -> int:
    """Append literal rows; missing fields are NULL, which required columns reject."""
    table = TABLES[name]
    values = [tuple(row.get(c) for c in table.columns) for row in rows]
    write_table(spark.createDataFrame(values, table.schema), layout, name)
    return len(values)


def first_available(*sources: Callable[[], DataFrame | None]) -> DataFrame:
    """The first source that exists; a source answers None when it does not.

    Errors of an existing source are raised, not skipped.
    """
    for source in sources:
        df = source()
        if df is not None:
            return df
    raise LookupError("none of the sources is available")


def available(spark: SparkSession, layout: Layout, name: str) -> DataFrame | None:
    return read_table(spark, layout, name) if table_exists(spark, layout, name) else None


def register_tables(spark: SparkSession, layout: Layout) -> list[str]:
    """Expose every existing table to `spark.sql` under its own name."""
    names = [n for n in TABLES if table_exists(spark, layout, n)]
    for name in names:
        read_table(spark, layout, name).createOrReplaceTempView(name)
    return names


def run_sql(spark: SparkSession, statement: str, args: Mapping | None = None, **tables) -> DataFrame:
    """SQL over the registered tables, or over frames named as `{name}` in the text.

    Values are bound as `:name` parameters, never pasted into the text.
    """
    return spark.sql(statement, args=dict(args) if args else None, **tables)


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out
