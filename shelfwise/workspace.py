"""The staged tables one source folder gives, each built on first use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .operators import cleaning, coerce, order_stats, rollups, rules
from .schema import FACT_COLUMNS, RAW_COLUMNS
from .sources.files import read_raw, read_raw_lenient
from .sources.publish import names
from .sources.store import stage, stage_path, staged, written
from .sources.tables import raw_from_tables


class Workspace:
    """All reports run on any extract: derived from the order tables of a folder, or given by `extract`.

    A given extract is read where it lies; only the derived one is stored as a table of its own.
    """

    def __init__(self, spark: SparkSession, source: str, extract: Callable[[], DataFrame] | None = None, max_rejects: float | None = None):
        self.spark = spark
        self.source = source.rstrip("/")
        self.extract = extract
        self.max_rejects = max_rejects

    @classmethod
    def from_csv(cls, spark: SparkSession, path: str, max_rejects: float | None = None) -> Workspace:
        """Workspace on a dirty CSV extract, read strictly.

        With `max_rejects`, values that can't be typed become NULL and malformed lines are left out, as long as
        no larger share of the rows than that is concerned; `rejects` lists them.
        """
        if max_rejects is None:
            return cls(spark, path, lambda: read_raw(spark, path))
        return cls(spark, path, lambda: read_raw_lenient(spark, path), max_rejects)

    @classmethod
    def from_table(cls, spark: SparkSession, name: str) -> Workspace:
        """Workspace on a table of the 13 raw text columns."""
        return cls(spark, f"table:{name}", lambda: spark.table(name).select(RAW_COLUMNS))

    def path(self, name: str) -> str:
        return stage_path(self.spark, self.source, name)

    def _stage(self, name, build, partition_by=None, figures=None, unstored=None) -> DataFrame:
        return stage(self.spark, self.source, name, build, partition_by, figures, unstored)

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table of the reports' own, written on first use."""
        return self._stage(name, build)

    def raw(self) -> DataFrame:
        """Staging: the untouched text extract."""
        if self.extract:
            return self.extract()
        return self._stage("raw", lambda: raw_from_tables(self.spark, self.source))

    def raw_once(self) -> DataFrame:
        """The extract for a report that reads it once: an extract that isn't stored yet is not stored for that."""
        if self.extract or staged(self.spark, self.source, "raw"):
            return self.raw()
        return raw_from_tables(self.spark, self.source)

    def raw_figures(self) -> DataFrame:
        """Gaps and defects of the extract in one row, counted in one scan when a report first asks for them."""
        return self._stage("raw_figures", lambda: self.raw().agg(*rules.raw_figures()))

    def copies(self) -> DataFrame:
        """Rows that the extract has more than once."""
        return self._stage("copies", lambda: rules.copied_rows(self.raw(), written))

    def grain_sizes(self) -> DataFrame:
        """How many item-outlet pairs of the extract have how many rows."""
        return self._stage("grain_sizes", lambda: rules.grain_sizes(self.raw()))

    def labels(self) -> DataFrame:
        """Rows of the extract per combination of its labels."""
        return self._stage("labels", lambda: rules.label_rows(self.raw()))

    def unique(self) -> DataFrame:
        """Typed rows without copies, before imputation. The typed rows are stored once; the copies are left out as they are read."""
        if self.max_rejects is not None:
            return self._stage("unique", lambda: coerce.unique_rows(self.spark, self._lenient()))
        return cleaning.unique_rows(cleaning.type_columns(self.raw_once()), lambda rows, name: self._stage(f"unique_{name}", lambda: rows))

    def _lenient(self) -> str:
        """Root of the lenient load, made on first use."""
        root = self.path("lenient")
        if not names(self.spark, root):
            coerce.load(self.raw(), root, self.max_rejects)
        return root

    def rejects(self) -> DataFrame:
        """Every value that couldn't be typed, with its place and reason."""
        if self.max_rejects is None:
            raise ValueError("a strict load has no rejects: it fails on the first one")
        return coerce.rejected(self.spark, self._lenient())

    def weight_by_item(self) -> DataFrame:
        return self._stage("weight_by_item", lambda: cleaning.median_weight_by_item(self.unique()))

    def medians_by_type(self) -> DataFrame:
        return self._stage("medians_by_type", lambda: cleaning.medians_by_type(self.unique()))

    def fact(self) -> DataFrame:
        """The clean fact table, partitioned by order year; sorted inside, so that category filters skip row groups.

        The digest of a row is half of its stored size, and few reports read it or all parts of the date, so what follows
        from other columns is made when it is read.
        """
        def build():
            return cleaning.deal_by_year(self.unique(), self.weight_by_item(), self.medians_by_type())
        return self._stage("fact", build, ["order_year"]).transform(cleaning.derive).select(FACT_COLUMNS)

    def fact_figures(self) -> DataFrame:
        """Broken rules and sums of the fact table in one row, counted in one scan when a report first asks for them."""
        return self._stage("fact_figures", lambda: self.fact().agg(*rules.fact_figures()))

    def pair_sizes(self) -> DataFrame:
        """How many item-outlet pairs of the fact table have how many rows."""
        return self._stage("pair_sizes", lambda: rules.grain_sizes(self.fact()))

    def products(self) -> DataFrame:
        """Measures per item, category and fat content."""
        return self._stage("products", lambda: rollups.product_rollup(self.fact()))

    def outlets(self) -> DataFrame:
        """Measures per outlet and order year."""
        return self._stage("outlets", lambda: rollups.outlet_rollup(self.fact()))

    def shelves(self) -> DataFrame:
        """Measures per outlet and category."""
        return self._stage("shelves", lambda: rollups.shelf_rollup(self.fact()))

    def stocks(self) -> DataFrame:
        """Measures per product and outlet."""
        return self._stage("stocks", lambda: rollups.stock_rollup(self.fact()))

    def ratings(self) -> DataFrame:
        """Measures per category and rating."""
        return self._stage("ratings", lambda: rollups.rating_rollup(self.fact()))

    def visibility_tiles(self) -> DataFrame:
        """Sums per fifth and per tenth of the rows by shelf visibility."""
        return self._stage("visibility_tiles", lambda: order_stats.visibility_tiles(self.fact(), [5, 10]))

    def quintile_tiles(self) -> DataFrame:
        return self.visibility_tiles().where("tiles = 5").drop("tiles")

    def decile_tiles(self) -> DataFrame:
        return self.visibility_tiles().where("tiles = 10").drop("tiles")

    def cells(self) -> DataFrame:
        """Measures per month, category and segment."""
        return self._stage("cells", lambda: rollups.cell_rollup(self.fact()))

    def stars(self) -> DataFrame:
        """Rows per filter field and rating."""
        return self._stage("stars", lambda: rollups.star_rollup(self.fact()))

    def assortment(self) -> DataFrame:
        """Rows and sales per product and filter field."""
        return self._stage("assortment", lambda: rollups.assortment_rollup(self.fact()))

    def item_numbers(self) -> DataFrame:
        """The number of every item in the bitmaps."""
        return self._stage("item_numbers", lambda: rollups.number_items(self.assortment()))

    def bitmaps(self) -> DataFrame:
        """The items sold per filter field, as bitmaps."""
        return self._stage("bitmaps", lambda: rollups.item_bitmaps(self.assortment(), self.item_numbers()))
