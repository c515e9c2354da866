"""Validation of provenance manifests, many at once, and a fail-closed gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators.contract import FORMULA_PREFIX, SCHEMA_VERSION, stripped
from orderlens.sources.files import PROVENANCE_SCHEMA, ContractError

_NAMED = ("source_name", "source_type", "license_or_authorization")
FIELDS = tuple(field.name for field in PROVENANCE_SCHEMA.fields)


def _is_text(raw: Column, name: str) -> Column:
    """True when the JSON value itself is a string, not a number or an object."""
    return F.schema_of_variant(F.try_variant_get(raw, f"$.{name}", "variant")) == "STRING"


def _rules() -> list[tuple[str, Column]]:
    raw = F.col("parsed")
    value = {name: F.try_variant_get(raw, f"$.{name}", "string") for name in FIELDS}
    flag = {
        name: F.try_variant_get(raw, f"$.{name}", "boolean")
        for name in ("identifiers_pseudonymized", "contains_direct_identifiers")
    }
    is_flag = {
        name: F.schema_of_variant(F.try_variant_get(raw, f"$.{name}", "variant")) == "BOOLEAN"
        for name in flag
    }
    # A key that holds JSON null is present, so presence is read from the object's keys.
    keys = F.json_object_keys("manifest")
    rules = [("valid_json_object", keys.isNotNull())]
    rules.append(
        ("all_fields_present", F.size(F.array_except(F.array(*map(F.lit, FIELDS)), keys)) == 0)
    )
    rules.append(
        (
            "schema_version_supported",
            _is_text(raw, "schema_version") & (value["schema_version"] == SCHEMA_VERSION),
        )
    )
    for name in _NAMED:
        text = stripped(value[name])
        rules.append((f"{name}_not_blank", _is_text(raw, name) & (text != "")))
        rules.append((f"{name}_no_formula_prefix", ~text.rlike(FORMULA_PREFIX)))
    rules.append(
        (
            "identifiers_pseudonymized",
            is_flag["identifiers_pseudonymized"] & flag["identifiers_pseudonymized"],
        )
    )
    rules.append(
        (
            "no_direct_identifiers",
            is_flag["contains_direct_identifiers"] & ~flag["contains_direct_identifiers"],
        )
    )
    return [(name, F.coalesce(passed, F.lit(False))) for name, passed in rules]


def provenance_report(manifests: DataFrame) -> DataFrame:
    """(file, rule, passed) for each manifest; the parsed fields ride along in ``fields``."""
    checks = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(name).alias("rule"),
                passed.alias("passed"),
            )
            for position, (name, passed) in enumerate(_rules(), start=1)
        ]
    )
    return manifests.withColumn("parsed", F.try_parse_json("manifest")).select(
        "file", F.inline(checks)
    )


def provenance_fields(manifests: DataFrame) -> DataFrame:
    """The six contract fields of each manifest; other fields are dropped."""
    return manifests.select(F.from_json("manifest", PROVENANCE_SCHEMA).alias("m")).select("m.*")


def require_provenance(manifests: DataFrame) -> DataFrame:
    """The fields of the manifests, or the first broken rule as an error."""
    if manifests.isEmpty():
        raise ContractError("A provenance manifest is required")
    broken = (
        provenance_report(manifests)
        .filter(~F.col("passed"))
        .orderBy("position", "file")
        .limit(1)
        .collect()
    )
    if broken:
        raise ContractError(f"Provenance {broken[0]['file']}: {broken[0]['rule']}")
    return provenance_fields(manifests)
