"""Where a measure gets its tables from."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..config import SiteConfig
from .schemas import schema


class Source:
    """Clinical tables by name plus the site's settings.

    Tables are opened on first use and the same DataFrame is handed out afterwards, so a
    table read twice in one measure is one plan node for exchange reuse.
    """

    def __init__(self, load: Callable[[str], DataFrame], config: SiteConfig | None = None):
        self._load = load
        self._open: dict[str, DataFrame] = {}
        self.config = config or SiteConfig()
        self.consents: tuple[DataFrame, date] | None = None

    def table(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._load(name)
        return self._open[name]

    def with_consents(self, state: DataFrame, until: date) -> "Source":
        """This source with a consent state (see ``extend_state``) of all notes up to a day."""
        out = Source(self.table, self.config)
        out.consents = (state, until)
        return out

    @classmethod
    def parquet(cls, spark: SparkSession, root: str, config: SiteConfig | None = None) -> "Source":
        """One Parquet folder per table under ``root``, read with the declared schema."""
        return cls(lambda name: spark.read.schema(schema(name)).parquet(f"{root}/{name}"), config)

    @classmethod
    def frames(cls, tables: Mapping[str, DataFrame], config: SiteConfig | None = None) -> "Source":
        return cls(tables.__getitem__, config)
