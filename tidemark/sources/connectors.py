"""Option builders for stores that run outside Spark.

Addresses and credentials are arguments.  Each builder returns the options of
a public Spark connector, so a read is
``spark.read.format(c.format).options(**c.read_options()).load()``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTable:
    """A relational table; ``partition`` splits a read into ranges of a numeric or time column."""

    url: str
    table: str
    user: str
    password: str = field(repr=False)
    driver: str = "com.mysql.cj.jdbc.Driver"
    partition: tuple[str, str, str, int] | None = None
    fetch_size: int = 10_000
    batch_size: int = 10_000
    format: str = "jdbc"

    def _base(self) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, "user": self.user, "password": self.password}

    def _ranges(self) -> dict[str, str]:
        if self.partition is None:
            return {}
        column, low, high, n = self.partition
        return {
            "partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(n),
        }

    def read_options(self) -> dict[str, str]:
        return {**self._base(), "dbtable": self.table, "fetchsize": str(self.fetch_size), **self._ranges()}

    def since_options(self, mark, version: str = "updated_at") -> dict[str, str]:
        """Only rows as new as the mark or newer, filtered by the database itself."""
        subquery = f"(SELECT * FROM {self.table} WHERE {version} >= '{mark:%Y-%m-%d %H:%M:%S.%f}') AS changed"
        return {**self.read_options(), "dbtable": subquery}

    def write_options(self) -> dict[str, str]:
        return {**self._base(), "dbtable": self.table, "batchsize": str(self.batch_size)}


@dataclass(frozen=True)
class MongoCollection:
    uri: str = field(repr=False)
    database: str
    collection: str
    format: str = "mongodb"

    def read_options(self) -> dict[str, str]:
        return {"connection.uri": self.uri, "database": self.database, "collection": self.collection}

    def write_options(self) -> dict[str, str]:
        return self.read_options()


@dataclass(frozen=True)
class KafkaTopic:
    servers: str
    topic: str
    starting: str = "latest"
    fail_on_data_loss: bool = False
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    format: str = "kafka"

    def read_options(self) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        if self.min_partitions:
            options["minPartitions"] = str(self.min_partitions)
        return options

    def write_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, "topic": self.topic}


def read(spark: SparkSession, source) -> DataFrame:
    return spark.read.format(source.format).options(**source.read_options()).load()


def read_since(spark: SparkSession, source: JdbcTable, mark, version: str = "updated_at") -> DataFrame:
    return spark.read.format(source.format).options(**source.since_options(mark, version)).load()


def read_stream(spark: SparkSession, source: KafkaTopic) -> DataFrame:
    return spark.readStream.format(source.format).options(**source.read_options()).load()
