"""Run queries and their SQL counterparts side by side: python -m checks.compare [sf_dir] [name ...]"""

import sys
import time
from collections import Counter

import duckdb
import pyarrow as pa

from checks.oracle import oracle_sql
from checks.queries import queries

TABLES = "region nation customer supplier part orders lineitem events documents benchmark pages labels".split()


def rows(table: pa.Table) -> Counter:
    """Multiset of rows with columns by name."""
    columns = [table.column(name).to_pylist() for name in sorted(table.column_names)]
    return Counter(zip(*columns))


def types(table: pa.Table) -> set:
    return {(field.name, str(field.type)) for field in table.schema}


def run_sql(sf_dir: str, sql: str) -> pa.Table:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection.sql(sql).to_arrow_table()


def main() -> int:
    from risklake.session import session_builder

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        session_builder()
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sql = oracle_sql()
    failed = 0
    for name, query in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            ours = query(spark, sf_dir).toArrow()
        except Exception as error:
            failed += 1
            print(f"ERROR {name} {str(error)[:600]}")
            continue
        seconds = time.time() - start
        theirs = run_sql(sf_dir, sql[name])
        left, right = rows(ours), rows(theirs)
        same = types(ours) == types(theirs) and left == right
        failed += not same
        print(f"{'ok   ' if same else 'DIFF '} {name} rows={ours.num_rows}/{theirs.num_rows} {seconds:.2f}s")
        if not same:
            print("   columns", types(ours) ^ types(theirs))
            print("   only spark", list((left - right).items())[:3], "\n   only sql", list((right - left).items())[:3])
    return failed


if __name__ == "__main__":
    sys.exit(main())
