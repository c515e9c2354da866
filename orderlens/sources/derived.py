"""Test inputs that Spark derives from the given tables: dirty text and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.sources.tables import TRANSACTION_COLUMNS, padded_id


def as_text(transactions: DataFrame) -> DataFrame:
    """The nine contract columns as a delimited file would hold them."""
    money = ("order_value", "contribution_margin")
    return transactions.select(
        *[
            F.col(c).cast("decimal(18,2)").cast("string").alias(c)
            if c in money
            else F.col(c).cast("string").alias(c)
            for c in TRANSACTION_COLUMNS
        ]
    )


def dirty_text(transactions: DataFrame) -> DataFrame:
    """Text rows with one defect wherever the order key hits a fixed modulus."""
    key = F.col("order_key")

    def hit(modulus: int) -> Column:
        return key % modulus == 0

    text = transactions.select(
        "order_key",
        *[F.col(c) for c in as_text(transactions).columns if c not in _MONEY],
        *[F.col(c).cast("decimal(18,2)").cast("string").alias(c) for c in _MONEY],
    )
    date_text = F.col("order_date").cast("string")
    dirty = {
        "order_id": F.when(hit(131), padded_id("O", key - 1, 10)).otherwise(F.col("order_id")),
        "customer_id": F.when(
            hit(101), F.concat(F.lit("="), F.col("customer_id"))
        ).otherwise(F.col("customer_id")),
        "order_date": F.when(hit(103), F.concat(date_text, F.lit(" 10:30:00")))
        .when(hit(107), "2001-02-30")
        .otherwise(date_text),
        "category": F.when(hit(97), "   ")
        .when(hit(137), F.lower("category"))
        .otherwise(F.concat(F.lit(" "), F.col("category"), F.lit(" "))),
        "order_value": F.when(hit(109), F.concat(F.lit("-"), F.col("order_value"))).otherwise(
            F.col("order_value")
        ),
        "contribution_margin": F.when(hit(113), "abc").otherwise(F.col("contribution_margin")),
        "used_discount": F.when(hit(127), "2").otherwise(F.col("used_discount").cast("string")),
        "acquisition_channel": F.col("acquisition_channel"),
        "region": F.when(~hit(139), F.col("region")),
    }
    return text.select(*[dirty[name].alias(name) for name in TRANSACTION_COLUMNS])


_MONEY = ("order_value", "contribution_margin")


def manifests(customer: DataFrame) -> DataFrame:
    """One provenance manifest per customer, some of them defective."""
    key = F.col("c_custkey")
    name = (
        F.when(key % 13 == 0, "  ")
        .when(key % 17 == 0, F.concat(F.lit(" ="), F.col("c_name")))
        .otherwise(F.col("c_name"))
    )
    document = F.to_json(
        F.struct(
            F.when(key % 11 == 0, "2.0").otherwise("1.0").alias("schema_version"),
            name.alias("source_name"),
            F.col("c_mktsegment").alias("source_type"),
            F.when(key % 19 != 0, "approved").alias("license_or_authorization"),
            (key % 23 != 0).alias("identifiers_pseudonymized"),
            (key % 29 == 0).alias("contains_direct_identifiers"),
            F.col("c_acctbal").alias("ignored_extra"),
        )
    )
    return customer.select(
        F.concat(F.lit("manifest-"), key.cast("string")).alias("file"),
        F.when(key % 31 == 0, "{not json").otherwise(document).alias("manifest"),
    )
