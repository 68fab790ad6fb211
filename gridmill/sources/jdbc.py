"""Table and query scans over JDBC.

The default store is Parquet; JDBC is for warehouses that already exist. A
scan without bounds reads through a single task, so a large table names a
numeric, date or timestamp column and its range.
"""


def scan_options(url, table=None, *, query=None, column=None, lower=None, upper=None, partitions=None,
                 fetch_size=10000, **properties):
    """Reader options of a table, or of the statement `query`."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    dbtable = table if query is None else f"({query.strip()}) AS scanned"
    options = {"url": url, "dbtable": dbtable, "fetchsize": str(fetch_size), **properties}
    bounds = (column, lower, upper, partitions)
    if any(b is not None for b in bounds):
        if any(b is None for b in bounds):
            raise ValueError("column, lower, upper and partitions go together")
        options.update(
            partitionColumn=column, lowerBound=str(lower), upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def read_jdbc(spark, url, table=None, **options):
    return spark.read.format("jdbc").options(**scan_options(url, table, **options)).load()


def count_jdbc(spark, url, table, **properties):
    """Row count computed by the warehouse; errors surface, never a silent zero."""
    query = f"SELECT count(*) AS row_count FROM {table}"
    return read_jdbc(spark, url, query=query, **properties)
