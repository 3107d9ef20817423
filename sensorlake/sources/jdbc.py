"""Statistics tables in a relational database, through Spark's JDBC source.

Spark appends without a transaction over the three tables and repeats a batch it could not
confirm, so the plain sink is at-least-once. ``StagedTables`` has Spark write each table of a batch into a
staging table and then moves all of them, with a mark of the batch, in one transaction of the database.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession


def options(url: str, table: str, driver: str | None = None, user: str | None = None, password: str | None = None) -> dict[str, str]:
    named = {"url": url, "dbtable": table, "driver": driver, "user": user, "password": password}
    return {key: value for key, value in named.items() if value is not None}


def writer(df: DataFrame, url: str, table: str, connections: int = 8, **access: str | None) -> DataFrameWriter:
    """Appending writer that opens at most ``connections`` database connections."""
    return (
        df.write.format("jdbc")
        .options(**options(url, table, **access), numPartitions=str(connections), batchsize="10000")
        .mode("append")
    )


def sink(url: str, prefix: str = "", connections: int = 8, **access: str | None) -> Callable[[DataFrame, str], None]:
    """Sink for the statistics of a stream; a table is named ``prefix`` and its own name.

    At-least-once: a micro-batch that is repeated after a failure is appended again.
    """
    return lambda rows, table: writer(rows, url, f"{prefix}{table}", connections, **access).save()


class StagedTables:
    """Sink of a stream's statistics that applies a batch once, however often it is repeated.

    For every table there is a staging table of the same columns named ``<table>_staged``, and for all a
    table ``applied_batches`` (batch_id BIGINT PRIMARY KEY), all with ``prefix`` before their names. ``run`` executes
    statements in one transaction and returns the rows of the last, by default over a connection of its own.
    """

    def __init__(
        self, spark: SparkSession, url: str, columns: dict[str, Sequence[str]], prefix: str = "", connections: int = 8,
        run: Callable[[Sequence[str]], list[tuple]] | None = None, **access: str | None,
    ):
        self._url, self._columns, self._prefix, self._connections, self._access = url, columns, prefix, connections, access
        self._run = run or (lambda statements: _transaction(spark, url, statements, **access))

    def committed(self, batch_id: int) -> bool:
        return bool(self._run([f"SELECT batch_id FROM {self._prefix}applied_batches WHERE batch_id = {int(batch_id)}"]))

    def stage(self, rows: DataFrame, table: str, batch_id: int) -> None:
        staged = f"{self._prefix}{table}_staged"
        writer(rows.select(*self._columns[table]), self._url, staged, self._connections, **self._access).mode("overwrite").option("truncate", "true").save()

    def statements(self, batch_id: int) -> list[str]:
        """What moves a staged batch into place; a batch that is marked already fails as a whole on the mark's key."""
        moved = []
        for table, columns in self._columns.items():
            named = ", ".join(columns)
            moved.append(f"INSERT INTO {self._prefix}{table} ({named}) SELECT {named} FROM {self._prefix}{table}_staged")
        return [f"INSERT INTO {self._prefix}applied_batches (batch_id) VALUES ({int(batch_id)})", *moved]

    def commit(self, batch_id: int) -> None:
        self._run(self.statements(batch_id))


def _transaction(spark: SparkSession, url: str, statements: Sequence[str], **access: str | None) -> list[tuple]:
    """Run statements in one transaction on a connection of the driver program."""
    properties = spark._jvm.java.util.Properties()
    for name, value in options(url, "", **access).items():
        if name in ("user", "password"):
            properties.setProperty(name, value)
    if access.get("driver"):
        spark._jvm.java.lang.Class.forName(access["driver"])
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, properties)
    found: list[tuple] = []
    try:
        connection.setAutoCommit(False)
        for text in statements:
            statement = connection.createStatement()
            if statement.execute(text):
                rows = statement.getResultSet()
                while rows.next():
                    found.append((rows.getObject(1),))
            statement.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()
    return found


def reader(spark: SparkSession, url: str, table: str, batches: tuple[int, int] | None = None, connections: int = 8, **access: str | None) -> DataFrameReader:
    """Reader of a table; ``batches`` splits the read over ranges of ``batch_id``."""
    result = spark.read.format("jdbc").options(**options(url, table, **access))
    if batches is not None:
        low, high = batches
        result = result.options(partitionColumn="batch_id", lowerBound=str(low), upperBound=str(high + 1), numPartitions=str(connections))
    return result
