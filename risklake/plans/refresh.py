"""Full refresh of all layers from raw files."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from risklake.operators.stage import deleting_staged, even_splits
from risklake.plans import gold, silver
from risklake.sources.delimited import read_raw
from risklake.sources.schemas import SOURCES


@dataclass(frozen=True)
class Refresh:
    """Where a refresh wrote, its tables and views by name, and the row count of each table."""

    path: str
    tables: dict[str, DataFrame]
    views: dict[str, DataFrame]
    audit: DataFrame


def count_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table, in one job. For Parquet tables the counts come from the file footers."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("registros")).select(F.lit(name).alias("tabela"), "registros")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def _store(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


RANKING = "gold_ranking_risco_clientes"
#: the cleaned tables that the ranking reads
RANKED = ("clientes", "emprestimos", "eventos_risco")


def _publish(path: str, tables: dict[str, DataFrame], ranking: DataFrame) -> Refresh:
    """Derive the views and point all names to these tables. Runs no job: views are computed when they are read, but
    for the ranking, which the refresh has stored."""
    clientes, emprestimos, pagamentos, _ = (tables[f"silver_{entity}"] for entity in SOURCES)
    views = gold.views(clientes, emprestimos, pagamentos, ranking)
    for name, df in {**tables, **views}.items():
        df.createOrReplaceTempView(name)
    return Refresh(path, tables, views, count_rows(tables))


def refresh(spark: SparkSession, source: str, target: str, version: str | None = None) -> Refresh:
    """Read the raw files below ``source`` and write both table layers below ``target``/``version``.

    Each refresh writes a version of its own, so readers of an older one are not disturbed and a failed one leaves
    them as they were. The names of tables and views are moved to the new version at the end, when all of it is
    written. Any bad file shape, missing column or failed write raises.
    """
    version = version or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")
    path = f"{target.rstrip('/')}/{version}"

    def load(entity: str) -> tuple[DataFrame, DataFrame]:
        origin = SOURCES[entity]
        raw = read_raw(spark, f"{source.rstrip('/')}/{origin.file}", origin)
        bronze = _store(raw.withColumn("_ingestao", F.current_timestamp()), f"{path}/{origin.table}")
        return bronze, _store(silver.TABLES[entity](bronze), f"{path}/silver_{entity}")

    # the entities do not depend on each other: the tail of one table runs beside the next. Payments, the largest, come
    # last, so that the ranking, which does not read them, runs beside them: Spark serves what was submitted first
    with even_splits(spark), ThreadPoolExecutor(len(SOURCES)) as pool:
        loading = {entity: pool.submit(load, entity) for entity in RANKED}
        ranked = [loading[entity].result()[1] for entity in RANKED]
        loading |= {entity: pool.submit(load, entity) for entity in SOURCES if entity not in RANKED}
        with deleting_staged(spark):
            ranking = _store(gold.ranking_risco_clientes(*ranked), f"{path}/{RANKING}")
        loaded = {entity: loading[entity].result() for entity in SOURCES}
    tables = {SOURCES[entity].table: bronze for entity, (bronze, _) in loaded.items()}
    tables |= {f"silver_{entity}": clean for entity, (_, clean) in loaded.items()}
    return _publish(path, tables, ranking)


def reopen(spark: SparkSession, path: str) -> Refresh:
    """The version that an earlier refresh wrote to ``path``, with all names pointed to it."""
    names = [origin.table for origin in SOURCES.values()] + [f"silver_{entity}" for entity in SOURCES]
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in names}
    return _publish(path, tables, spark.read.parquet(f"{path}/{RANKING}"))


def export_views(result: Refresh) -> dict[str, DataFrame]:
    """Store the views of a refresh as Parquet next to its tables."""
    stored = {RANKING: result.views[RANKING]}
    return stored | {name: _store(df, f"{result.path}/{name}") for name, df in result.views.items() if name != RANKING}
