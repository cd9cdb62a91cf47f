"""The list of checked queries: name, DataFrame, SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from carelake.operators import flatten
from carelake.plans import cost, disparity
from carelake.sources import bundles
from carelake.testbed import star
from carelake.testbed.oracle_views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Lake:
    """The clinical tables of one scale factor, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def star(self, name: str) -> DataFrame:
        return star.star(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        return star.flat(self.spark, self.sf_dir, name)

    def parsed(self, name: str) -> DataFrame:
        """The entries of a table's resources, parsed from bundle documents."""
        documents = star.documents(self.spark, self.sf_dir, name)
        return bundles.entries(bundles.parse_bundles(documents, F.col("document")))

    def resource_texts(self) -> DataFrame:
        """The resources of all twelve tables as JSON text, from bundle documents."""
        return bundles.resource_texts(star.documents(self.spark, self.sf_dir), F.col("document"))

    def from_documents(self, name: str) -> DataFrame:
        return flatten.TABLES[name](self.parsed(name))

    def csv(self) -> DataFrame:
        return star.encounter_csv(self.spark, self.sf_dir)

    # Inputs of the cost reports.
    def claims(self):
        return cost.claim_view(self.table("claim"))

    def encounters(self):
        return cost.encounter_view(self.table("encounter"))

    def people(self):
        return cost.patient_view(self.table("patient"))

    def procedures(self):
        return cost.procedure_view(self.table("procedure"))

    # Inputs of the disparity reports.
    def clean_patients(self):
        return disparity.clean_patients(self.table("patient"), star.AS_OF)

    def clean_encounters(self):
        return disparity.clean_encounters(self.table("encounter"))

    def known(self):
        return disparity.encounters_with_patients(self.clean_encounters(), self.clean_patients())

    def totals(self):
        return disparity.encounter_totals(self.clean_encounters(), self.clean_patients())

    def usual_totals(self):
        usual = disparity.without_outliers(self.clean_encounters())
        return disparity.encounter_totals(usual, self.clean_patients())

    def eob(self):
        return self.table("explanation_of_benefit")

    def weights(self):
        usual = disparity.without_outliers(self.clean_encounters())
        return disparity.patient_weights(usual, self.clean_patients())

    def claim_lines(self):
        return disparity.claim_lines(self.eob())

    def lines(self):
        return disparity.lines_with_demographics(self.claim_lines(), self.weights())

    def category_totals(self):
        return disparity.category_totals(self.eob(), self.weights())


def comparable(df: DataFrame, money: Sequence[str] = ()) -> DataFrame:
    """Columns in a form two engines print alike: whole numbers as long, other numbers to four places
    (to cents for the large sums named in `money`), times as text."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if name in money:
            c = F.round(c.cast("double"), 2)
        elif kind in ("double", "float"):
            # The offset settles values that lie half-way, whose last bit may differ.
            c = F.round(c.cast("double") + F.lit(1e-9), 4)
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("long")
        elif kind == "timestamp":
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(name))
    return df.select(*out)


def query(name: str, sql: str | None = None, money: Sequence[str] = ()):
    """Register `f(lake) -> DataFrame` with the SQL that gives the same rows."""

    def register(build: Callable[[Lake], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return comparable(build(Lake(spark, sf_dir)), money)

        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql:
            ORACLES[name] = with_views(sql)
        return build

    return register
