"""Where the lake lives and what its schemas are called."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class LakeConfig:
    """``root`` is a folder all executors share; each schema gets one folder below it."""

    root: str
    catalog: str | None = None
    raw: str = "raw"
    curated: str = "curated"
    gold: str = "gold"

    def qualify(self, schema: str, table: str) -> str:
        return qualify(schema, table, self.catalog)

    def location(self, schema: str) -> str:
        return f"{self.root}/{schema}"


def qualify(schema: str, table: str, catalog: str | None = None) -> str:
    """Quoted table name, with the catalog in front if one is given."""
    parts = [p for p in (catalog, schema, table) if p and p.lower() != "none"]
    return ".".join(f"`{p}`" for p in parts)


def shared_folder(spark: SparkSession) -> str:
    """A folder every executor can reach: the checkpoint folder, or where none is set the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
