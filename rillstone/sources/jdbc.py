"""Serving tables in a relational database. The driver is loaded only when a table is read or written."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcDatabase:
    url: str
    user: str
    password: str
    driver: str = "org.postgresql.Driver"
    batch_size: int = 10_000
    connections: int = 16

    @classmethod
    def postgres(cls, host: str, port: int | str, database: str, user: str, password: str) -> JdbcDatabase:
        return cls(f"jdbc:postgresql://{host}:{port}/{database}", user, password)

    def options(self) -> dict[str, str]:
        return {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}

    def write_options(self, table: str) -> dict[str, str]:
        # numPartitions bounds the open connections, whatever the width of the DataFrame.
        return {
            **self.options(),
            "dbtable": table,
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.connections),
        }

    def read_options(self, table: str, split: tuple[str, str, str] | None = None) -> dict[str, str]:
        """`split` is (column, lower, upper): the scan becomes `connections` range queries on it."""
        chosen = {**self.options(), "dbtable": table, "pushDownAggregate": "true"}
        if split:
            column, lower, upper = split
            chosen.update(
                partitionColumn=column,
                lowerBound=lower,
                upperBound=upper,
                numPartitions=str(self.connections),
            )
        return chosen

    def read(self, spark: SparkSession, table: str, split: tuple[str, str, str] | None = None) -> DataFrame:
        return spark.read.format("jdbc").options(**self.read_options(table, split)).load()

    def append(self, rows: DataFrame, table: str) -> None:
        """Append; a failure is raised so that the micro-batch is retried instead of lost.

        The writer would merge tasks down to the number of connections, and with them the stage before;
        a shuffle in between leaves that stage its width.
        """
        rows = rows.repartition(self.connections)
        rows.write.format("jdbc").options(**self.write_options(table)).mode("append").save()
