"""Small published code lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fareledger.session import literal_table

# Published code-to-name lists.
SEEDS = {
    "vendors": ("vendor_id int, vendor_name string", [
        (1, "Creative Mobile Technologies, LLC"),
        (2, "Curb Mobility, LLC"),
        (6, "Myle Technologies Inc"),
        (7, "Helix"),
    ]),
    "rate_codes": ("rate_code_id bigint, rate_code_name string", [
        (1, "Standard rate"),
        (2, "JFK"),
        (3, "Newark"),
        (4, "Nassau or Westchester"),
        (5, "Negotiated fare"),
        (6, "Group ride"),
        (99, "Null/unknown"),
    ]),
    "payment_types": ("payment_type bigint, payment_type_name string", [
        (0, "Flex Fare trip"),
        (1, "Credit card"),
        (2, "Cash"),
        (3, "No charge"),
        (4, "Dispute"),
        (5, "Unknown"),
        (6, "Voided trip"),
    ]),
}


def read_seed(spark: SparkSession, name: str) -> DataFrame:
    """One seed as a literal relation of a few rows, which Catalyst broadcasts by itself."""
    ddl, rows = SEEDS[name]
    return literal_table(spark, rows, ddl)
