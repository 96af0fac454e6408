"""Settings from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrameReader, SparkSession


@dataclass(frozen=True)
class Settings:
    """Fixed values, the defaults, and what the environment puts in their place."""

    topics: tuple[str, ...] = ("cs.AI", "cs.CL", "cs.LG", "cs.IR", "stat.ML")
    max_results: int = 50
    interval_seconds: int = 21600
    max_pdf_mb: int = 50
    chunk_tokens: int = 512
    overlap_tokens: int = 64
    min_chunk_chars: int = 100
    embedding_provider: str = "hashing"
    embedding_batch: int = 100

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ, prefix: str = "INKLOOM_") -> Settings:
        """Values of the variables <prefix><FIELD>; numbers that aren't numbers are an error."""
        found = {}
        for name, default in cls.__dataclass_fields__.items():
            raw = env.get(prefix + name.upper())
            if raw is not None:
                found[name] = parse_topics(raw) if name == "topics" else int(raw) if isinstance(default.default, int) else raw
        return cls(**found)


@dataclass(frozen=True)
class Database:
    """Fixed values, the defaults of a database that tables can be read from and written to."""

    host: str = "localhost"
    port: int = 5432
    name: str = "papers"
    user: str = "papers"
    password: str = ""
    connections: int = 10
    fetch_rows: int = 10_000
    timeout_seconds: int = 30

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ, prefix: str = "INKLOOM_DB_") -> Database:
        found = {f: env[prefix + f.upper()] for f in cls.__dataclass_fields__ if prefix + f.upper() in env}
        return cls(**{k: int(v) if isinstance(getattr(cls, k), int) else v for k, v in found.items()})

    def address(self) -> str:
        return f"postgresql://{self.user}:{self.password}@{self.host}:{self.port}/{self.name}"

    def options(self) -> dict[str, str]:
        """Options of Spark's jdbc source and sink: at most `connections` at a time, statements that end in time."""
        return {"url": f"jdbc:postgresql://{self.host}:{self.port}/{self.name}", "user": self.user, "password": self.password, "numPartitions": str(self.connections), "fetchsize": str(self.fetch_rows), "queryTimeout": str(self.timeout_seconds)}

    def reader(self, spark: SparkSession, table: str, key: str | None = None, least: int = 0, most: int = 0) -> DataFrameReader:
        """A reader of a table, in parts by ranges of a whole-number key if there is one."""
        reader = spark.read.format("jdbc").options(**self.options()).option("dbtable", table)
        return reader if key is None else reader.option("partitionColumn", key).option("lowerBound", least).option("upperBound", most)


def parse_topics(raw: str) -> tuple[str, ...]:
    return tuple(t.strip() for t in raw.split(",") if t.strip())


def redacted(url: str) -> str:
    """An address without the password in it, for logs."""
    head, mark, rest = url.partition("://")
    user, at, host = rest.rpartition("@")
    return f"{head}{mark}{user.split(':')[0]}:***@{host}" if at and ":" in user else url
