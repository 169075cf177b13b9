"""Export of the serving tables to a relational store, or to files for one."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roastery import schemas
from roastery.operators.quality import verify_counts
from roastery.rules import SERVING_KEYS

DEFAULT_BATCH = 1000


def relational(table: str, df: DataFrame) -> DataFrame:
    """Declared column types, so text stays text: a phone keeps its leading zeros."""
    return schemas.conform(df, table) if table in schemas.STAR else df


def jdbc_options(table: str, options: Mapping[str, str], connections: int, batch_size: int) -> dict[str, str]:
    """Writer options for one table; connection details are the caller's and pass through."""
    return {
        "truncate": "true",
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
        **options,
        "dbtable": f"{options['schema']}.{table}" if "schema" in options else table,
    }


def export_tables(
    tables: Mapping[str, DataFrame],
    options: Mapping[str, str],
    fmt: str = "jdbc",
    mode: str = "overwrite",
    connections: int = 8,
    batch_size: int = DEFAULT_BATCH,
) -> list[str]:
    """Full load of each table; returns the names loaded.

    jdbc writes from the executors over ``connections`` parallel connections in
    batches.  Any file format writes below ``options['path']``, for stores that
    bulk-load files.
    """
    for name, df in tables.items():
        rows = relational(name, df)
        if fmt == "jdbc":
            sink = {k: v for k, v in jdbc_options(name, options, connections, batch_size).items() if k != "schema"}
            rows.write.format("jdbc").mode(mode).options(**sink).save()
        else:
            own = {k: v for k, v in options.items() if k != "path"}
            rows.write.format(fmt).mode(mode).options(**own).save(f"{options['path']}/{name}")
    return list(tables)


def read_exported(
    spark: SparkSession, name: str, options: Mapping[str, str], fmt: str = "jdbc"
) -> DataFrame:
    """An exported table, read back with its declared types."""
    if fmt == "jdbc":
        sink = {k: v for k, v in jdbc_options(name, options, 1, DEFAULT_BATCH).items() if k in options or k == "dbtable"}
        sink.pop("schema", None)
        return relational(name, spark.read.format("jdbc").options(**sink).load())
    own = {k: v for k, v in options.items() if k != "path"}
    reader = spark.read.format(fmt).options(**own)
    if name in schemas.STAR:
        reader = reader.schema(schemas.STAR[name])
    return reader.load(f"{options['path']}/{name}")


def verify_export(
    spark: SparkSession, tables: Mapping[str, DataFrame], options: Mapping[str, str], fmt: str = "jdbc"
) -> DataFrame:
    """Row counts of the source and of the store, per table."""
    return verify_counts(tables, {n: read_exported(spark, n, options, fmt) for n in tables})


def key_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, duplicate_keys: keys that occur more than once, which a keyed store would refuse."""
    return reduce(
        DataFrame.union,
        [
            df.groupBy(SERVING_KEYS[name])
            .count()
            .agg(F.count_if(F.col("count") > 1).alias("duplicate_keys"))
            .select(F.lit(name).alias("table_name"), "duplicate_keys")
            for name, df in tables.items()
        ],
    )
