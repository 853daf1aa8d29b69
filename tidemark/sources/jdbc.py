"""Connection options for any JDBC database."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from tidemark.sources.slices import slice_predicates

# Fixed value: rows per round trip.
DEFAULT_FETCH_SIZE = 10_000


def jdbc_url(endpoint: str, settings: Mapping[str, str | int | bool] | None = None) -> str:
    """``jdbc:<endpoint>;name=value;...``; True and False are written as drivers spell them."""
    pairs = {name: json.dumps(v) if isinstance(v, bool) else str(v) for name, v in (settings or {}).items()}
    return f"jdbc:{endpoint}" + "".join(f";{name}={value}" for name, value in pairs.items()) + ";" * bool(pairs)


@dataclass(frozen=True)
class JdbcTable:
    """One table of a database, readable and writable."""

    url: str
    table: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    fetch_size: int = DEFAULT_FETCH_SIZE
    batch_size: int | None = None
    # Parallel connections: for reading, slices of the range of ``slices`` or of the dates
    # asked for; for writing, an upper limit. A database takes far fewer connections than a
    # cluster has tasks.
    connections: int | None = None
    # Column, lower and upper bound to slice reads by. Rows beyond the bounds are read as well.
    slices: tuple[str, str, str] | None = None
    # One condition per slice, such as those of `slice_predicates`; they take the place of ``slices``.
    predicates: tuple[str, ...] | None = None
    # Column types to use when Spark has to create the table.
    column_types: str | None = None
    extra: Mapping[str, str] = field(default_factory=dict)

    def connection(self) -> dict[str, str]:
        named = {"user": self.user, "password": self.password, "driver": self.driver}
        return {
            "url": self.url,
            "dbtable": self.table,
            **{k: v for k, v in named.items() if v is not None},
            **self.extra,
        }

    def read_options(
        self, order: str | None = None, start: str | None = None, end: str | None = None
    ) -> dict[str, str]:
        """Options of a read, in slices if several connections are allowed.

        Slices need bounds: ``slices``, or a date range of ``order``. Several connections without
        bounds are refused, because all rows would come through one.
        """
        options = {**self.connection(), "fetchsize": str(self.fetch_size)}
        if (self.connections or 1) < 2 or self.predicates:
            return options
        dated = (order, f"{start} 00:00:00", f"{end} 00:00:00") if order and start and end else None
        bounds = self.slices or dated
        if bounds is None:
            raise ValueError(
                f"{self.table}: {self.connections} connections need slices=(column, lower, upper)"
            )
        named = dict(zip(("partitionColumn", "lowerBound", "upperBound"), map(str, bounds)))
        return options | named | {"numPartitions": str(self.connections)}

    def counts_query(self, column: str) -> JdbcTable:
        """The table as counts per value of a column (value, n), grouped by the database.

        They come through one connection: a row per day or symbol, to plan slices from."""
        query = f"(SELECT {column} AS value, COUNT(*) AS n FROM {self.table} GROUP BY {column}) counted"
        return replace(self, table=query, connections=None, slices=None, predicates=None)

    def in_slices(self, column: str, bounds: Sequence) -> JdbcTable:
        """The table read in slices between the bounds, a connection each."""
        return replace(self, predicates=tuple(slice_predicates(column, bounds)))

    def catalog_settings(self, name: str) -> dict[str, str]:
        """Session settings that make the database a catalog called ``name``.

        Scans of its tables hand filters, aggregates, sorting and limits to the database, so a
        report over ``name.schema.table`` fetches groups instead of rows."""
        prefix = f"spark.sql.catalog.{name}"
        options = {k: v for k, v in self.connection().items() if k != "dbtable"}
        pushed = ("pushDownPredicate", "pushDownAggregate", "pushDownLimit", "pushDownOffset")
        return {
            prefix: "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog",
            **{f"{prefix}.{k}": v for k, v in options.items()},
            **{f"{prefix}.{k}": "true" for k in pushed},
        }

    def write_options(self, mode: str) -> dict[str, str]:
        options = self.connection()
        if self.batch_size:
            options["batchsize"] = str(self.batch_size)
        if self.connections:
            options["numPartitions"] = str(self.connections)
        if self.column_types:
            options["createTableColumnTypes"] = self.column_types
        if mode == "overwrite":
            # Keeps the table's own definition and indexes instead of recreating it.
            options["truncate"] = "true"
        return options
