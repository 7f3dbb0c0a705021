"""Where the operators cut lineage: parquet tables in the cluster's shared
checkpoint folder, so a lost executor costs the tasks it held, not the job."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import checkpoint_dir


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under ``spark.checkpoint.dir`` and read it
    back with its known schema."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/ledgerline-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def input_partitions(spark: SparkSession, default: int = 8) -> int:
    """The session's shuffle width: what the cluster sized for its input."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", str(default))), default)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def append_columns(df: DataFrame, make, added: str, *args: str) -> DataFrame:
    """All columns of ``df`` and, from ``make(batch columns named in args)``,
    the columns of the DDL ``added``; ``make`` returns one Arrow array for each.
    The added names must be the caller's private ones, so that they cannot
    clash with a column of ``df``."""
    import pyarrow as pa
    from pyspark.sql import types as ST

    extra = ST.StructType.fromDDL(added)
    positions = [df.columns.index(a) for a in args]
    names = [*df.columns, *extra.names]

    def run(batches):
        for batch in batches:
            new = make(*[batch.column(i) for i in positions])
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=names)

    return df.mapInArrow(run, ST.StructType([*df.schema.fields, *extra.fields]))


def staged_by(spark: SparkSession, df: DataFrame, key: str, name: str) -> DataFrame:
    """Like ``staged``, but bucketed by ``key``: later groupings and joins on it
    read the files in place and only move their other side. Rows of one task
    should share few keys, for each task writes one file per bucket it has."""
    table = f"ledgerline_llm_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/ledgerline-llm/{table}"
    df.write.format("parquet").bucketBy(input_partitions(spark), key).option("path", path).saveAsTable(table)
    return spark.table(table)
