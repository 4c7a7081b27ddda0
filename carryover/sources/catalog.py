"""Tables known to a catalog (Hive metastore or the session catalog)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions.names import qualify, quote_ref, split_ref, target_table_name


@dataclass(frozen=True)
class CatalogSource:
    """Reads ``database.table`` references through ``spark.table``.

    ``metastore_uri`` set: the session needs Hive support and that
    metastore (S7).  Unset: whatever catalog the session already has.
    """

    database: str = "default"
    metastore_uri: str | None = None
    kind: str = "catalog"

    def session_settings(self) -> dict[str, str]:
        if not self.metastore_uri:
            return {}
        return {
            "spark.sql.catalogImplementation": "hive",
            "spark.hadoop.hive.metastore.uris": self.metastore_uri,
        }

    def resolve(self, ref: str) -> str:
        return qualify(ref, self.database)

    def target_name(self, ref: str) -> str:
        return target_table_name(split_ref(self.resolve(ref))[-1])

    def read(self, spark: SparkSession, ref: str) -> DataFrame:
        return spark.table(quote_ref(self.resolve(ref)))

    def exists(self, spark: SparkSession, ref: str) -> bool:
        return spark.catalog.tableExists(quote_ref(self.resolve(ref)))
