"""Reading and writing booking tables by name or by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodgeline.files import children, delete, exists, replace_folder, restore_folders, swap
from lodgeline.operators.cleaning import require
from lodgeline.operators.tables import ensure_columns, one_per_key, stamp, upsert
from lodgeline.schemas import BOOKING, INGESTED_AT, KEY

MODES = ("overwrite", "append", "upsert")
KEY_BUCKET = "key_bucket"
#: Property of a named table in key folders: how many.
BUCKETS_PROPERTY = "lodgeline.key_buckets"


def read_bookings_csv(spark: SparkSession, path: str) -> DataFrame:
    """Bookings from CSV with a header. The schema is given, so there is no inference pass.

    A header whose names differ from the schema is an error.
    """
    return spark.read.schema(BOOKING).option("header", True).option("enforceSchema", False).csv(path)


def is_path(name: str) -> bool:
    return "/" in name


def read_table(spark: SparkSession, name: str, schema: StructType | None = None) -> DataFrame:
    """A table by qualified name or by path. Columns added by later writes are null in older rows.

    Without a schema, that of a path table is merged from all its files by a job of its own.
    """
    if not is_path(name):
        return spark.table(name).drop(KEY_BUCKET)
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    return reader.parquet(name).drop(KEY_BUCKET)


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether there is a table; a folder that holds markers only is none yet."""
    if not is_path(name):
        return spark.catalog.tableExists(name)
    return any(not n.startswith(("_", ".")) for n in children(spark, name))


def row_count(spark: SparkSession, name: str) -> int:
    """Rows of a table; a missing table counts 0."""
    return read_table(spark, name).count() if table_exists(spark, name) else 0


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    key: str = KEY,
    buckets: int = 0,
    partition_by: str | None = None,
    batch_id: int | None = None,
) -> None:
    """Write a table in one of the modes. The first write of any mode creates the table.

    With `buckets`, a table is laid out in folders by key hash. An upsert then reads and rewrites only the folders its
    keys fall in; choose the count so that a folder is about 1 GB. The count is stored with the table at its first write,
    and an append with another one is an error. With `partition_by`, a table without key folders is laid out in
    folders of that column. `batch_id` is the number of the micro-batch that an upsert brings; see `last_batch`.
    """
    if mode not in MODES:
        raise ValueError(f"invalid write mode {mode!r}, expected one of {MODES}")
    if buckets and partition_by:
        raise ValueError("a table has key folders or folders of a column, not both")
    spark = df.sparkSession
    if mode == "upsert":
        require(df, [key])
        if table_exists(spark, name):
            _upsert_table(df, name, key)
        else:
            _create_or_append(one_per_key(df, key, _order(df)), name, "append", key, buckets, partition_by)
        if batch_id is not None:
            _number_marker(spark, _batch_marker(spark, name), batch_id)
        return
    _create_or_append(df, name, mode, key, buckets, partition_by)


def _create_or_append(df: DataFrame, name: str, mode: str, key: str, buckets: int, partition_by: str | None) -> None:
    spark = df.sparkSession
    appended = mode == "append" and table_exists(spark, name)
    if appended:
        stored = bucket_count(spark, name)
        if buckets not in (0, stored):
            raise ValueError(f"{name} has {stored} key buckets, not {buckets}")
        buckets = stored
        if partition_by and folder_columns(spark, name) != [partition_by]:
            raise ValueError(f"{name} has no folders by {partition_by}")
    if buckets:
        df, folders = with_bucket(df, key, buckets).hint("rebalance", KEY_BUCKET), [KEY_BUCKET]
    elif partition_by:
        # Rows of a folder meet before the write, so that it gets few files; AQE splits a large folder.
        df, folders = df.hint("rebalance", partition_by), [partition_by]
    else:
        folders = []
    if not is_path(name):
        if appended:
            _evolve(df, name).write.insertInto(name)
        else:
            df.write.mode(mode).partitionBy(*folders).saveAsTable(name)
            if buckets:
                spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{BUCKETS_PROPERTY}' = '{buckets}')")
        return
    # A table whose data came without its marker would be taken for one without key folders.
    if buckets and mode == "append" and not appended:
        _number_marker(spark, _buckets_marker(name), buckets)
    df.write.mode(mode).partitionBy(*folders).parquet(name)
    if buckets and mode == "overwrite":
        _number_marker(spark, _buckets_marker(name), buckets)


def _order(df: DataFrame) -> str | None:
    return INGESTED_AT if INGESTED_AT in df.columns else None


def _evolve(df: DataFrame, name: str) -> DataFrame:
    """Add the frame's new columns to the table, and the table's other columns to the frame."""
    spark = df.sparkSession
    stored = {f.name: f.dataType.simpleString() for f in spark.table(name).schema}
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in stored]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")
    return ensure_columns(df, stored).select(*spark.table(name).columns)


def with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(KEY_BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def _buckets_marker(name: str) -> str:
    return f"{name.rstrip('/')}/_key_buckets"


def _batch_marker(spark: SparkSession, name: str) -> str:
    return f"{location(spark, name)}/_last_batch"


def _number_marker(spark: SparkSession, path: str, number: int) -> None:
    spark.range(number, number + 1).coalesce(1).write.mode("overwrite").json(path)


def _marked(spark: SparkSession, path: str, otherwise: int) -> int:
    if not exists(spark, f"{path}/_SUCCESS"):
        return otherwise
    return spark.read.schema("id bigint").json(path).first()["id"]


def bucket_count(spark: SparkSession, name: str) -> int:
    """Number of key folders a table was created with; 0 if it has none."""
    if is_path(name):
        return _marked(spark, _buckets_marker(name), 0)
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == BUCKETS_PROPERTY).first()
    return int(found["value"]) if found else 0


def last_batch(spark: SparkSession, name: str) -> int:
    """Number of the last micro-batch that an upsert has finished; -1 before the first.

    It is written after the data. A batch that broke off in between is put in again, which changes nothing.
    """
    return _marked(spark, _batch_marker(spark, name), -1) if table_exists(spark, name) else -1


def folder_columns(spark: SparkSession, name: str) -> list[str]:
    """Columns whose values name the folders of a table."""
    if not is_path(name):
        return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    place, out = name.rstrip("/"), []
    while found := [n for n in children(spark, place) if "=" in n and not n.startswith(("_", "."))]:
        out.append(found[0].split("=")[0])
        place = f"{place}/{found[0]}"
    return out


def location(spark: SparkSession, name: str) -> str:
    """Folder of a table."""
    if is_path(name):
        return name.rstrip("/")
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return described.filter("col_name = 'Location'").first()["data_type"].rstrip("/")


def _folders_of(rows: DataFrame) -> list[int]:
    return [r[0] for r in rows.select(KEY_BUCKET).distinct().collect()]  # at most as many numbers as folders


def _stored(spark: SparkSession, name: str) -> DataFrame:
    """A table with the column of its key folders."""
    return spark.read.option("mergeSchema", True).parquet(name) if is_path(name) else spark.table(name)


def touched_rows(rows: DataFrame, name: str, key: str = KEY) -> DataFrame:
    """The rows of a table in the key folders that the keys of `rows` fall in; all of a table without key folders."""
    spark = rows.sparkSession
    buckets = bucket_count(spark, name)
    if not buckets:
        return read_table(spark, name)
    touched = _folders_of(with_bucket(rows.select(key), key, buckets))
    return _stored(spark, name).filter(F.col(KEY_BUCKET).isin(touched)).drop(KEY_BUCKET)


def _upsert_table(source: DataFrame, name: str, key: str) -> None:
    spark = source.sparkSession
    buckets = bucket_count(spark, name)
    if buckets:
        _upsert_buckets(source, name, key, buckets)
        return
    # A table cannot be overwritten while it is read: the merged rows land beside it first.
    merged = upsert(read_table(spark, name), source, key)
    if is_path(name):
        staging = f"{name.rstrip('/')}__staging"
        merged.write.mode("overwrite").parquet(staging)
        swap(spark, staging, name)
        return
    staging = f"{name}__staging"
    merged.write.mode("overwrite").saveAsTable(staging)
    # Inserted into the table as it is, which keeps its partitions.
    _evolve(spark.table(staging), name).write.insertInto(name, overwrite=True)
    spark.sql(f"DROP TABLE {staging}")


def _upsert_buckets(source: DataFrame, name: str, key: str, buckets: int) -> None:
    """Merge into the key folders the source touches; the others are neither read nor written.

    The merged folders are written beside the table and put in place one by one, by renaming. A folder that a crash has
    left aside is put back before the next merge.
    """
    spark = source.sparkSession
    place = location(spark, name)
    restore_folders(spark, place)
    source = with_bucket(source, key, buckets)
    touched = _folders_of(source)
    if not touched:
        return
    if not is_path(name):
        source = _evolve(source, name)
    target = _stored(spark, name).filter(F.col(KEY_BUCKET).isin(touched))
    # Rows of a folder meet before the write, so that it gets few files; AQE splits a large folder.
    merged = upsert(target, source, key).hint("rebalance", KEY_BUCKET)
    staging = f"{place}__staging"
    merged.write.mode("overwrite").partitionBy(KEY_BUCKET).parquet(staging)
    for k in touched:
        replace_folder(spark, staging, place, f"{KEY_BUCKET}={k}")
    delete(spark, staging)
    if is_path(name):
        spark.catalog.refreshByPath(name)
        return
    parts = " ".join(f"PARTITION ({KEY_BUCKET} = {k})" for k in touched)
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    spark.catalog.refreshTable(name)


def save_sets(
    train: DataFrame,
    test: DataFrame,
    names: tuple[str, str],
    inference_name: str,
    job_type: str = "training",
    mode: str = "overwrite",
) -> None:
    """Stamp and write the train and test sets, or the test set alone as rows to be scored."""
    if job_type == "training":
        write_table(stamp(train), names[0], mode)
        write_table(stamp(test), names[1], mode)
    elif job_type == "inference":
        write_table(stamp(test), inference_name, mode)
    else:
        raise ValueError(f"unknown job type {job_type!r}, expected 'training' or 'inference'")
