"""Versions of the published tables.

Every build writes into a database of its own. One change of the catalog, the property `current` of the base database,
publishes its tables together: readers see the version before or the new one, never some tables of each, and a build
that dies or fails a check leaves the version before as it was. Nothing is deleted until `drop_versions`.

A version made for some regions holds the rows of these only (`own_<table>`); its view `<table>` adds the rows that earlier
versions hold of the others. A view names each version at most once and at most one version a region, however many
reloads came before it.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from snapmart.sources.sinks import location_of, write_table

_MARK = "__v"
_OWNERS = "owners"


def base_of(spark: SparkSession) -> str:
    """The database whose versions the session works with."""
    return spark.catalog.currentDatabase().split(_MARK)[0]


def published(spark: SparkSession) -> str | None:
    """The database of the published version."""
    rows = spark.sql(f"DESCRIBE DATABASE EXTENDED {base_of(spark)}").filter("info_name = 'Properties'").collect()
    found = re.search(r"\(current,([^)]+)\)", rows[0][1]) if rows else None
    return found and found.group(1)


def use_published(spark: SparkSession) -> None:
    """Tables are those of the published version from now on; without one, those of the base database."""
    spark.catalog.setCurrentDatabase(published(spark) or base_of(spark))


def drop_versions(spark: SparkSession, keep: int = 2) -> list[str]:
    """Drop all versions but the newest `keep` up to the published one, and what their views read. Returns the dropped ones.

    Builds that began after it are left alone; those that began before and weren't published go, as they no longer could
    be published. A reader of a dropped version fails.
    """
    current = published(spark)
    names = sorted(r[0] for r in spark.sql(f"SHOW DATABASES LIKE '{base_of(spark)}{_MARK}*'").collect())
    if current is None:
        return []
    complete = [n for n in names if n <= current and spark.catalog.tableExists(f"{n}.{_OWNERS}")]
    kept = set(complete[-keep:]) | {current}
    for name in list(kept):
        kept |= {r[0] for r in spark.table(f"{name}.{_OWNERS}").select("version").distinct().collect()}
    gone = [n for n in names if n <= current and n not in kept]
    for name in gone:
        spark.sql(f"DROP DATABASE {name} CASCADE")
    return gone


class Version:
    """The version that is being built; its database is current."""

    def __init__(self, spark: SparkSession, name: str, before: str | None):
        self.spark, self.name, self.before = spark, name, before
        self._owners: list[tuple[str, str, list[str] | None]] = []

    def write(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write this version's own rows of a table and return them as read back."""
        return write_table(df, f"own_{name}", partition_by)

    def view(self, name: str, column: str, regions: Iterable[str] | None) -> DataFrame:
        """The whole table: own rows, and if these are of some `regions` only, the other regions' rows of earlier versions."""
        owners: list[tuple[str, list[str] | None]] = [(self.name, None if regions is None else sorted(regions))]
        if regions is not None:
            earlier = self.spark.table(f"{self.before}.{_OWNERS}").filter(f"table_name = '{name}'").collect()
            for r in earlier:  # at most one row a region, and one for all others
                left = None if r.regions is None else sorted(set(r.regions) - set(regions))
                if left != []:
                    owners.append((r.version, left))
        taken = sorted(r for _, some in owners for r in some or ())
        columns = ", ".join(f"`{c}`" for c in self.spark.table(f"own_{name}").columns)

        def rows(version: str, some: list[str] | None) -> str:
            test = "true"
            if some is not None:
                test = f"{column} IN ({_texts(some)})" if some else "false"
            elif taken:
                test = f"coalesce({column} NOT IN ({_texts(taken)}), true)"
            return f"SELECT {columns} FROM {version}.own_{name} WHERE {test}"

        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS " + " UNION ALL ".join(rows(*o) for o in owners))
        self._owners += [(name, *o) for o in owners]
        return self.spark.table(name)

    def publish(self) -> None:
        """Make this the published version."""
        write_table(self.spark.createDataFrame(self._owners, "table_name string, version string, regions array<string>"), _OWNERS)
        if published(self.spark) != self.before:
            raise RuntimeError(f"another build was published after {self.name} began; build again")
        self.spark.sql(f"ALTER DATABASE {base_of(self.spark)} SET DBPROPERTIES ('current' = '{self.name}')")


def _texts(values: Iterable[str]) -> str:
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


@contextmanager
def new_version(spark: SparkSession) -> Iterator[Version]:
    """A version to write into. It is published if the block ends; the published one is current afterwards in any case."""
    base, before = base_of(spark), published(spark)
    name = f"{base}{_MARK}{datetime.datetime.now(datetime.UTC):%Y%m%d%H%M%S%f}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{location_of(spark, base)}/versions/{name}'")
    spark.catalog.setCurrentDatabase(name)
    try:
        version = Version(spark, name, before)
        yield version
        version.publish()
    finally:
        use_published(spark)
