"""The set of logical inputs a run needs, from catalog tables or files."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from .schema import LOGICAL_SCHEMAS, validate
from .shards import read_shards


def _named(spark: SparkSession, name: str, input_name: str) -> DataFrame:
    if name.endswith("*"):
        return read_shards(spark, name, schema=LOGICAL_SCHEMAS[input_name])
    return validate(spark.table(name), input_name)


@dataclass
class RetailInputs:
    """Logical inputs (see :mod:`shopscope.sources.schema`).

    Any object with these attribute names works as input to the jobs in
    :mod:`shopscope.plans.jobs`; :class:`~shopscope.sources.fixtures.FixtureInputs`
    is the test-data implementation.
    """

    loyalty_customer: DataFrame
    loyalty_member: DataFrame
    crm_customer: DataFrame
    cust_store: DataFrame
    dim_store: DataFrame
    location: DataFrame
    dim_item: DataFrame
    fact_sales: DataFrame
    date_dimension: DataFrame
    sendjobs: DataFrame
    opens: DataFrame
    clicks: DataFrame
    app_events: DataFrame

    @classmethod
    def from_tables(cls, spark: SparkSession, names: dict[str, str]) -> RetailInputs:
        """Read each input from a catalog table (``names`` maps input -> table name).

        Every table is checked against its logical schema.  Store the sale
        fact and the app events partitioned by date so that the rolling
        windows prune whole partitions.  A name ending in ``*`` is a family
        of day shards, as ``analytics.events_*`` for the app events (see
        :mod:`shopscope.sources.shards`); with a ``/`` in it, of folders.
        """
        return cls(**{f.name: _named(spark, names[f.name], f.name) for f in fields(cls)})

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> RetailInputs:
        """Read each input from ``<root>/<input name>`` (parquet)."""
        frames = {f.name: validate(spark.read.parquet(f"{root}/{f.name}"), f.name) for f in fields(cls)}
        return cls(**frames)
