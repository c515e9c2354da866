"""Contract checks on transaction text: report, quarantine and a fail-fast gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.scratch import stage
from orderlens.sources.files import ContractError
from orderlens.sources.tables import TRANSACTION_COLUMNS

# Fixed values of contract version 1.0.
SCHEMA_VERSION = "1.0"
LABEL_FIELDS = ("order_id", "customer_id", "category", "acquisition_channel", "region")
CLEANED_FIELDS = (*LABEL_FIELDS, "order_date")
NUMERIC_FIELDS = ("order_value", "contribution_margin", "used_discount")
FORMULA_PREFIX = "^[=+\\-@]"
DATE_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
NUMBER_PATTERN = (
    "(?i)^\\s*([+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)(e[+-]?[0-9]+)?|[+-]?(inf|infinity|nan))\\s*$"
)


def stripped(column: Column) -> Column:
    """Text without leading and trailing Unicode whitespace."""
    space = "[\\s\\x1c-\\x1f]+"
    return F.regexp_replace(F.regexp_replace(column, f"(?U)^{space}", ""), f"(?U){space}$", "")


def folded(category: Column) -> Column:
    """Full Unicode case folding: equal for two texts exactly if they differ in case only.

    Upper case writes out ligatures and sharp s and drops letter variants; lower case of that is the
    key. Dotless i has an upper case that is not its own and is kept apart, and the final form of
    sigma is the same letter as the others.
    """
    kept = "\uffff"
    upper = F.upper(F.translate(category, "ı\u1e9e", kept + "ß"))
    return F.translate(F.lower(F.translate(upper, kept, "ı")), "ς", "σ")


def parsed_date(text: Column) -> Column:
    return F.when(text.rlike(DATE_PATTERN), F.try_to_date(text, "yyyy-MM-dd"))


def parsed_number(text: Column) -> Column:
    return F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))


def is_finite(number: Column) -> Column:
    return F.coalesce(
        ~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))),
        F.lit(False),
    )


def cleaned(raw: DataFrame) -> DataFrame:
    """Contract columns with the text fields stripped."""
    return raw.select(
        *[
            stripped(F.col(name)).alias(name) if name in CLEANED_FIELDS else F.col(name)
            for name in TRANSACTION_COLUMNS
        ]
    )


def row_rules() -> list[tuple[str, Column]]:
    """(rule, violated) over cleaned rows, in the order in which they are enforced.

    The two rules that look across rows are placed by :data:`RULES`.
    """
    nulls = F.lit(False)
    for name in TRANSACTION_COLUMNS:
        nulls = nulls | F.col(name).isNull()
    rules = [("required_not_null", nulls)]
    for name in CLEANED_FIELDS:
        rules.append((f"{name}_not_blank", F.col(name) == ""))
        rules.append((f"{name}_no_formula_prefix", F.col(name).rlike(FORMULA_PREFIX)))
    well_formed = F.col("order_date").rlike(DATE_PATTERN)
    rules.append(("order_date_format", ~well_formed))
    rules.append(("order_date_valid", well_formed & parsed_date(F.col("order_date")).isNull()))
    for name in NUMERIC_FIELDS:
        rules.append(
            (
                f"{name}_finite",
                F.col(name).isNotNull() & ~is_finite(parsed_number(F.col(name))),
            )
        )
    value, discount = (parsed_number(F.col(c)) for c in ("order_value", "used_discount"))
    rules.append(("order_value_not_negative", value < 0))
    rules.append(("used_discount_binary", is_finite(discount) & ~discount.isin(0.0, 1.0)))
    return [(name, F.coalesce(violated, F.lit(False))) for name, violated in rules]


DUPLICATE_RULE = "order_id_unique"
CASEFOLD_RULE = "category_unique_after_folding"
_ROW_RULE_NAMES = [
    "required_not_null",
    *[
        f"{name}_{rule}"
        for name in LABEL_FIELDS
        for rule in ("not_blank", "no_formula_prefix")
    ],
]
RULES = (
    *_ROW_RULE_NAMES,
    DUPLICATE_RULE,
    CASEFOLD_RULE,
    "order_date_not_blank",
    "order_date_no_formula_prefix",
    "order_date_format",
    "order_date_valid",
    *[f"{name}_finite" for name in NUMERIC_FIELDS],
    "order_value_not_negative",
    "used_discount_binary",
)


def null_counts(raw: DataFrame) -> DataFrame:
    """(field, nulls) for each required field, one pass."""
    counts = raw.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in TRANSACTION_COLUMNS])
    return counts.unpivot([], list(TRANSACTION_COLUMNS), "field", "nulls")


def identifier_issues(raw: DataFrame) -> DataFrame:
    """(order_id, field, cleaned, issue) for blank or formula-prefixed texts."""
    checks = F.array(
        *[
            F.struct(
                F.lit(name).alias("field"),
                F.col(name).alias("cleaned"),
                F.when(F.col(name).isNull() | (F.col(name) == ""), "blank")
                .when(F.col(name).rlike(FORMULA_PREFIX), "formula_prefix")
                .alias("issue"),
            )
            for name in CLEANED_FIELDS
        ]
    )
    return (
        cleaned(raw)
        .select("order_id", F.inline(checks))
        .filter(F.col("issue").isNotNull())
    )


def duplicate_orders(raw: DataFrame) -> DataFrame:
    """(order_id, copies) of repeated order ids."""
    return _repeated(raw.select(stripped(F.col("order_id")).alias("order_id")))


def _repeated(rows: DataFrame) -> DataFrame:
    return (
        rows.select("order_id")
        .filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def category_labels(raw: DataFrame) -> DataFrame:
    """(folded, category, orders): one row per distinct label."""
    return _labels(raw.select(stripped(F.col("category")).alias("category")))


def _labels(rows: DataFrame) -> DataFrame:
    return (
        rows.select("category")
        .filter(F.col("category").isNotNull())
        .groupBy(folded(F.col("category")).alias("folded"), "category")
        .agg(F.count(F.lit(1)).alias("orders"))
    )


def casefold_clashes(raw: DataFrame) -> DataFrame:
    """(folded, category, orders, kept): labels equal to another one once case is folded.

    ``kept`` marks the label with most orders of its folded form, ties to the smallest.
    """
    return _clashes(category_labels(raw))


def _clashes(labels: DataFrame) -> DataFrame:
    clashing = (
        labels.groupBy("folded")
        .agg(
            F.count(F.lit(1)).alias("variants"),
            F.min(F.struct((-F.col("orders")).alias("negative"), "category")).alias("first"),
        )
        .filter(F.col("variants") > 1)
        .select("folded", F.col("first.category").alias("dominant"))
    )
    return labels.join(clashing, "folded").select(
        "folded", "category", "orders", (F.col("category") == F.col("dominant")).alias("kept")
    )


def date_issues(raw: DataFrame) -> DataFrame:
    """(order_id, order_date, issue): wrong shape, or no such day."""
    text = F.col("order_date")
    issue = F.when(~text.rlike(DATE_PATTERN), "format").when(
        parsed_date(text).isNull(), "invalid_day"
    )
    return (
        cleaned(raw)
        .select("order_id", "order_date", issue.alias("issue"))
        .filter(F.col("issue").isNotNull())
    )


def numeric_issues(raw: DataFrame) -> DataFrame:
    """(order_id, field, text, issue) for numbers outside the contract."""
    checks = []
    for name in NUMERIC_FIELDS:
        number = parsed_number(F.col(name))
        issue = F.when(F.col(name).isNull(), "missing").when(~is_finite(number), "not_finite")
        if name == "order_value":
            issue = issue.when(number < 0, "negative")
        if name == "used_discount":
            issue = issue.when(~number.isin(0.0, 1.0), "not_binary")
        checks.append(
            F.struct(
                F.lit(name).alias("field"), F.col(name).alias("text"), issue.alias("issue")
            )
        )
    return (
        cleaned(raw)
        .select("order_id", F.inline(F.array(*checks)))
        .filter(F.col("issue").isNotNull())
    )


@dataclass(frozen=True)
class Inspection:
    """One reading of an input: its cleaned rows, staged, and what the reading counted.

    ``rows`` carries ``broken``, the row rules that a row violates; ``counts`` the rows in all and per
    row rule. Repeated ids and labels come from two narrow columns of the staged rows.
    """

    rows: DataFrame
    counts: dict[str, int]

    def repeated(self) -> DataFrame:
        return _repeated(self.rows)

    def labels(self) -> DataFrame:
        return _labels(self.rows)


def inspect(raw: DataFrame) -> Inspection:
    """Read ``raw`` once and count the row rules over one narrow column of what was staged.

    An observed write would save that small second scan, but a session that has ever observed a
    query can no longer run fitted models (its observations do not serialize with them).
    """
    rules = row_rules()
    broken = F.array_compact(F.array(*[F.when(violated, F.lit(name)) for name, violated in rules]))
    rows = stage(cleaned(raw).withColumn("broken", broken), "inspected")
    counts = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.array_contains("broken", name)).alias(name) for name, _ in rules],
    )
    return Inspection(rows, counts.first().asDict())


def _as_inspected(given: DataFrame | Inspection) -> Inspection:
    return given if isinstance(given, Inspection) else inspect(given)


def contract_report(given: DataFrame | Inspection) -> DataFrame:
    """(position, rule, violations) for every rule, zero included.

    Duplicates count all copies of repeated ids; folding counts labels beyond the first of each
    folded form. The input is read once.
    """
    inspected = _as_inspected(given)
    repeated = inspected.repeated().agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n"))
    folding = (
        inspected.labels()
        .groupBy("folded")
        .agg(F.count(F.lit(1)).alias("variants"))
        .agg(F.coalesce(F.sum(F.col("variants") - 1), F.lit(0)).alias("n"))
    )
    across = {DUPLICATE_RULE: repeated.scalar(), CASEFOLD_RULE: folding.scalar()}
    spark = inspected.rows.sparkSession
    rules = [
        (at, name, inspected.counts.get(name, 0)) for at, name in enumerate(RULES, 1)
    ]
    violations = F.col("counted")
    for name, number in across.items():
        violations = F.when(F.col("rule") == name, number).otherwise(violations)
    return spark.createDataFrame(rules, "position int, rule string, counted long").select(
        "position", "rule", violations.cast("long").alias("violations")
    )


def with_violations(given: DataFrame | Inspection) -> DataFrame:
    """Cleaned rows plus ``violations``, the names of the broken rules in order.

    All copies of a repeated id are at fault; of labels that fold together, the most
    frequent one stays valid.
    The lookups of repeated ids and clashing labels are plain equi-joins: adaptive
    execution broadcasts them when they are small and otherwise splits the partition
    of an id or label that dominates.
    """
    inspected = _as_inspected(given)
    repeated = inspected.repeated().select("order_id", F.lit(True).alias("is_repeated"))
    clashing = (
        _clashes(inspected.labels())
        .filter("not kept")
        .select("category", F.lit(True).alias("is_clashing"))
    )
    across = {
        DUPLICATE_RULE: F.coalesce("is_repeated", F.lit(False)),
        CASEFOLD_RULE: F.coalesce("is_clashing", F.lit(False)),
    }
    names = F.array_compact(
        F.array(
            *[
                F.when(across.get(name, F.array_contains("broken", name)), F.lit(name))
                for name in RULES
            ]
        )
    )
    return (
        inspected.rows.join(repeated, "order_id", "left")
        .join(clashing, "category", "left")
        .select(*TRANSACTION_COLUMNS, names.alias("violations"))
    )


def typed(valid: DataFrame) -> DataFrame:
    """Contract types for rows that passed every rule."""
    return valid.select(
        "order_id",
        "customer_id",
        parsed_date(F.col("order_date")).alias("order_date"),
        "category",
        parsed_number(F.col("order_value")).alias("order_value"),
        parsed_number(F.col("contribution_margin")).alias("contribution_margin"),
        parsed_number(F.col("used_discount")).cast("int").alias("used_discount"),
        "acquisition_channel",
        "region",
    )


def quarantine(given: DataFrame | Inspection) -> tuple[DataFrame, DataFrame]:
    """(valid typed rows, rejected text rows with their violations)."""
    checked = with_violations(given)
    passed = F.size("violations") == 0
    return typed(checked.filter(passed)), checked.filter(~passed)


def require_valid(raw: DataFrame) -> tuple[DataFrame, int]:
    """Typed transactions and the number of rules passed, or the first broken rule.

    Only the report, one row per rule, reaches the driver.
    """
    inspected = inspect(raw)
    if not inspected.counts["rows"]:
        raise ContractError("Transaction input must not be empty")
    report = contract_report(inspected).orderBy("position").collect()
    for row in report:
        if row["violations"]:
            raise ContractError(f"{row['rule']}: {row['violations']} violations")
    return typed(inspected.rows), len(report)


def dataset_fingerprint(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Order-insensitive identity of a table: row count and combined row digests.

    Every row contributes its SHA-256 over the canonical text of ``columns``; sums over
    the leading 60 bits of the digests do not depend on how the table is stored.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]
    digest = F.sha2(F.concat_ws("\x1f", *text), 256)
    leading = F.conv(F.substring("digest", 1, 15), 16, 10).cast("decimal(20,0)")
    return frame.select(digest.alias("digest")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("digest").alias("least_digest"),
        F.max("digest").alias("greatest_digest"),
        F.sum(leading).cast("string").alias("digest_sum"),
    )
