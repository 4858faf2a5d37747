"""Layer databases and table locations.

A lake has three layers. Each has one database, ``{abbr}_{country}_{layer}``, whose location is
``{bucket of the layer}/{project}/{database}``; a table lives in a folder of its own below it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from stratalake import catalog

LAYERS = ("raw", "refined", "curated")


@dataclass(frozen=True)
class Lake:
    abbr: str
    country: str
    project: str
    buckets: Mapping[str, str]

    def database(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"layer must be one of {LAYERS}, not {layer!r}")
        return f"{self.abbr.replace('-', '_')}_{self.country}_{layer}"

    def database_location(self, layer: str) -> str:
        return f"{self.buckets[layer].rstrip('/')}/{self.project}/{self.database(layer)}"

    def table(self, layer: str, name: str) -> str:
        """Full name for the readers and writers."""
        return f"spark_catalog.{self.database(layer)}.{name}"

    def location(self, layer: str, name: str) -> str:
        return f"{self.database_location(layer)}/{name}"

    def create_databases(self, spark: SparkSession) -> None:
        for layer in LAYERS:
            catalog.create_database(
                spark,
                self.database(layer),
                location=self.database_location(layer),
                comment=f"{layer} layer of {self.abbr}",
                properties={"layer": layer},
            )


def resolve(spark: SparkSession, table: str) -> str:
    """Location of a table given as a path or as ``[catalog.]database.table``."""
    if "/" in table:
        return table.rstrip("/")
    *catalogs, database, name = table.split(".")
    if catalogs and catalogs != [spark.catalog.currentCatalog()]:
        raise ValueError(f"lake tables are in the session catalog, not in {catalogs[0]}: {table}")
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}"
