"""The stored tables of all layers: where they lie and how they are read.

Bronze and gold are plain Parquet folders, silver tables are keyed tables (``sources.keyed``), marks and run log are control tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from stratalith.sources.control import ControlTables
from stratalith.sources.files import overwrite_partitions, read_if_any
from stratalith.sources.keyed import KeyedTable, MissingTable
from stratalith.spec import ENRICHED, Layout

# What a bronze row carries if it is not taken further.
REJECT_COLUMNS = ("rejected", "rejected_value", "rejected_hash")
REJECTS = "_rejects"
# Columns that bronze adds for itself.
BATCH, MARK = "batch", "mark_micros"


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    layout: Layout

    @property
    def control(self) -> ControlTables:
        return ControlTables(self.spark, f"{self.layout.root}/{self.layout.control}")

    def path(self, layer: str, table: str) -> str:
        return f"{self.layout.root}/{layer}/{table}"

    def keyed(self, table: str) -> KeyedTable:
        """A silver table."""
        key = "order_item_id" if table == ENRICHED else self.layout.specs[table].key
        silver = self.layout.silver
        return KeyedTable(self.spark, f"{silver}.{table}", self.path(silver, table), key, self.layout.buckets)

    def is_keyed(self, layer: str, table: str) -> bool:
        return layer == self.layout.silver and (table == ENRICHED or table in self.layout.specs)

    def files(self, layer: str, table: str) -> DataFrame | None:
        """All rows of a plain table; None while it has none. Deliveries may bring columns along that earlier ones did not have."""
        return read_if_any(self.spark, self.path(layer, table), layer != self.layout.gold)

    def rows(self, layer: str, table: str) -> DataFrame:
        """All rows with what the layer adds to them."""
        found = self.keyed(table).rows() if self.is_keyed(layer, table) else self.files(layer, table)
        if found is None:
            raise MissingTable(f"{layer}.{table} has no rows yet")
        return found

    def current(self, layer: str, table: str) -> DataFrame:
        """The rows that later layers and readers see."""
        if self.is_keyed(layer, table):
            return self.keyed(table).current()
        found = self.rows(layer, table)
        if layer != self.layout.bronze:
            return found
        return found.filter(F.col("rejected") == 0).drop(*REJECT_COLUMNS, BATCH, MARK)

    def exists(self, layer: str, table: str) -> bool:
        return self.keyed(table).exists() if self.is_keyed(layer, table) else self.files(layer, table) is not None

    def overwrite(self, layer: str, table: str, df: DataFrame, observe: Mapping[str, Column], partition_by: Sequence[str] = ()) -> dict:
        """Replace a plain table, or those of its partitions that ``df`` has rows for; gives the ``observe`` aggregates of the rows."""
        if partition_by:
            return overwrite_partitions(df, self.path(layer, table), partition_by, observe)
        seen = Observation()
        df.observe(seen, *[c.alias(n) for n, c in observe.items()]).write.mode("overwrite").parquet(self.path(layer, table))
        return seen.get

    def view_text(self, layer: str, table: str) -> str:
        """What readers see of a plain table, as SQL over its files."""
        found = self.rows(layer, table)
        hidden = {*REJECT_COLUMNS, BATCH, MARK} if layer == self.layout.bronze else set()
        cols = ", ".join(f"`{c}`" for c in found.columns if c not in hidden)
        kept = " WHERE rejected = 0" if layer == self.layout.bronze else ""
        return f"SELECT {cols} FROM parquet.`{self.path(layer, table)}`{kept}"
