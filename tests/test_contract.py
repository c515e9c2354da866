import json
import shutil

import pytest
from pyspark.sql import functions as F

from orderlens.operators import contract, provenance
from orderlens.sources import files
from orderlens.sources.files import ContractError

GOOD = {
    "order_id": "00123",
    "customer_id": "c1",
    "order_date": "2024-02-29",
    "category": "Books",
    "order_value": "10.5",
    "contribution_margin": "-2",
    "used_discount": "1",
    "acquisition_channel": "web",
    "region": "north",
}
SCHEMA = ", ".join(f"{name} string" for name in GOOD)


def raw(spark, *rows):
    filled = [
        tuple((GOOD | {"order_id": f"o{i}"} | row).values()) for i, row in enumerate(rows)
    ]
    return spark.createDataFrame(filled, SCHEMA)


def test_rule_names_are_complete(spark):
    names = {name for name, _ in contract.row_rules()}
    assert names | {contract.DUPLICATE_RULE, contract.CASEFOLD_RULE} == set(contract.RULES)


BROKEN = [
    ({"region": None}, ["required_not_null"]),
    ({"customer_id": "   "}, ["customer_id_not_blank"]),
    ({"order_id": " =1+1"}, ["order_id_no_formula_prefix"]),
    ({"category": "@x"}, ["category_no_formula_prefix"]),
    ({"order_id": "same"}, ["order_id_unique"]),
    ({"order_id": " same "}, ["order_id_unique"]),
    ({"category": "books"}, ["category_unique_after_folding"]),
    ({"order_date": "-2024-01-01"}, ["order_date_no_formula_prefix", "order_date_format"]),
    ({"order_date": "2024-01-01 00:00:00"}, ["order_date_format"]),
    ({"order_date": "2024-1-1"}, ["order_date_format"]),
    ({"order_date": "2023-02-29"}, ["order_date_valid"]),
    ({"order_value": "ten"}, ["order_value_finite"]),
    ({"order_value": "10d"}, ["order_value_finite"]),
    ({"contribution_margin": "inf"}, ["contribution_margin_finite"]),
    ({"contribution_margin": "1e999"}, ["contribution_margin_finite"]),
    ({"used_discount": "True"}, ["used_discount_finite"]),
    ({"order_value": "-0.01"}, ["order_value_not_negative"]),
    ({"used_discount": "0.5"}, ["used_discount_binary"]),
    ({}, []),
]


def test_each_rule_rejects_its_rows(spark):
    marked = [
        change | {"acquisition_channel": f"case{i}"} for i, (change, _) in enumerate(BROKEN)
    ]
    table = raw(spark, *marked)
    found = {
        r["acquisition_channel"]: r["violations"]
        for r in contract.with_violations(table).collect()
    }
    assert found == {f"case{i}": rules for i, (_, rules) in enumerate(BROKEN)}
    report = {r["rule"]: r["violations"] for r in contract.contract_report(table).collect()}
    assert list(report) and set(report) == set(contract.RULES)
    for rule in contract.RULES:
        assert report[rule] == sum(rule in rules for _, rules in BROKEN), rule
    valid, rejected = contract.quarantine(table)
    assert (valid.count(), rejected.count()) == (1, len(BROKEN) - 1)


def test_first_rule_in_order_is_reported(spark):
    table = raw(spark, {"order_value": "-1"}, {"order_date": "x"}, {"region": None})
    with pytest.raises(ContractError, match="required_not_null"):
        contract.require_valid(table)
    with pytest.raises(ContractError, match="order_date_format"):
        contract.require_valid(table.filter("region is not null"))


def test_valid_rows_are_typed(spark):
    typed, passed = contract.require_valid(raw(spark, {"customer_id": " c9 ", "used_discount": "1.0"}))
    row = typed.first()
    assert passed == len(contract.RULES) == 22
    assert (row["customer_id"], row["used_discount"], row["contribution_margin"]) == ("c9", 1, -2.0)
    assert str(row["order_date"]) == "2024-02-29"


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_keeps_ids_and_ignores_extra_columns(spark, tmp_path):
    header = ",".join(["extra", *GOOD])
    path = write(tmp_path / "a.csv", f"{header}\nx,{','.join(GOOD.values())}\n")
    table = files.read_transactions_csv(spark, path)
    assert table.columns == list(GOOD)
    assert table.first()["order_id"] == "00123"
    assert contract.require_valid(table)[0].first()["order_id"] == "00123"


def test_missing_texts_and_quotes(spark, tmp_path):
    rows = [GOOD | {"category": text} for text in ('"a ""b"", c"', "NA", '""', "none")]
    lines = [",".join(GOOD)] + [",".join(r.values()) for r in rows]
    table = files.read_transactions_csv(spark, write(tmp_path / "b.csv", "\n".join(lines)))
    assert [r["category"] for r in table.collect()] == ['a "b", c', None, None, "none"]


def test_unreadable_inputs(spark, tmp_path):
    with pytest.raises(ContractError):
        files.read_transactions_csv(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(ContractError):
        files.read_transactions_csv(spark, write(tmp_path / "empty.csv", ""))
    with pytest.raises(ContractError, match="region"):
        files.read_transactions_csv(spark, write(tmp_path / "c.csv", "order_id,category\n1,a\n"))
    only_header = write(tmp_path / "d.csv", ",".join(GOOD) + "\n")
    with pytest.raises(ContractError, match="empty"):
        contract.require_valid(files.read_transactions_csv(spark, only_header))


def test_fingerprint_ignores_row_order_but_not_content(spark):
    table = raw(spark, *({} for _ in range(50)))
    columns = list(GOOD)
    first = contract.dataset_fingerprint(table, columns).first()
    assert first == contract.dataset_fingerprint(
        table.repartition(5).orderBy(F.desc("order_id")), columns
    ).first()
    changed = table.withColumn(
        "region", F.when(F.col("order_id") == "o7", "south").otherwise(F.col("region"))
    )
    assert first != contract.dataset_fingerprint(changed, columns).first()


MANIFEST = {
    "schema_version": "1.0",
    "source_name": "shop export",
    "source_type": "synthetic_fixture",
    "license_or_authorization": "made for tests",
    "identifiers_pseudonymized": True,
    "contains_direct_identifiers": False,
}


def manifest_rows(spark, *documents):
    return spark.createDataFrame(
        [
            (f"m{i}", d if isinstance(d, str) else json.dumps(d))
            for i, d in enumerate(documents)
        ],
        "file string, manifest string",
    )


def test_good_manifest_passes_and_extra_fields_are_dropped(spark):
    table = manifest_rows(spark, MANIFEST | {"note": "x"})
    assert provenance.require_provenance(table).first().asDict() == MANIFEST


BAD_MANIFESTS = [
    ({"schema_version": "2.0"}, "schema_version_supported"),
    ({"schema_version": 1.0}, "schema_version_supported"),
    ({"source_name": "  "}, "source_name_not_blank"),
    ({"source_name": None}, "source_name_not_blank"),
    ({"source_type": 7}, "source_type_not_blank"),
    ({"license_or_authorization": " @x"}, "license_or_authorization_no_formula_prefix"),
    ({"identifiers_pseudonymized": False}, "identifiers_pseudonymized"),
    ({"identifiers_pseudonymized": "true"}, "identifiers_pseudonymized"),
    ({"contains_direct_identifiers": True}, "no_direct_identifiers"),
    ({"contains_direct_identifiers": None}, "no_direct_identifiers"),
]


def test_manifest_rules(spark):
    table = manifest_rows(spark, MANIFEST, *[MANIFEST | change for change, _ in BAD_MANIFESTS])
    failed = (
        provenance.provenance_report(table)
        .filter("not passed")
        .groupBy("file")
        .agg(F.min_by("rule", "position").alias("first"))
    )
    assert {r["file"]: r["first"] for r in failed.collect()} == {
        f"m{i}": rule for i, (_, rule) in enumerate(BAD_MANIFESTS, start=1)
    }
    with pytest.raises(ContractError, match="m1: schema_version_supported"):
        provenance.require_provenance(table)


def test_incomplete_or_broken_manifests(spark):
    partial = {k: v for k, v in MANIFEST.items() if k != "source_type"}
    with pytest.raises(ContractError, match="all_fields_present"):
        provenance.require_provenance(manifest_rows(spark, partial))
    for text in ("{broken", "[1]", ""):
        with pytest.raises(ContractError, match="valid_json_object"):
            provenance.require_provenance(manifest_rows(spark, text))


def test_written_text_is_read_back(spark, tmp_path):
    texts = ['x, "y"', "a, b\\", '"', "plain", "tab\there", "back\\slash \"quoted\""]
    frame = spark.createDataFrame([(n, text) for n, text in enumerate(texts)], "n int, text string")
    files.write_csv(frame, str(tmp_path / "texts"))
    back = files.read_csv(spark, str(tmp_path / "texts"), "n int, text string")
    assert {row["n"]: row["text"] for row in back.collect()} == dict(enumerate(texts))


def test_input_is_read_once(spark, tmp_path):
    """The inspection reads the files in one pass; everything after it reads the staged rows."""
    rows = [(f"o{i % 40}", f"c{i}", "2024-01-01", "Books" if i % 9 else "books", "1", "1", "0", "a", "b") for i in range(50)]
    table = spark.createDataFrame(rows, ", ".join(f"{name} string" for name in files.TRANSACTION_COLUMNS))
    path = str(tmp_path / "in")
    files.write_csv(table, path)
    inspected = contract.inspect(files.read_transactions_csv(spark, path))
    shutil.rmtree(path)
    assert inspected.counts["rows"] == 50
    report = {r["rule"]: r["violations"] for r in contract.contract_report(inspected).collect()}
    assert report[contract.DUPLICATE_RULE] == 20 and report[contract.CASEFOLD_RULE] == 1
    valid, rejected = contract.quarantine(inspected)
    bad = {i for i in range(50) if i % 40 < 10 or i % 9 == 0}
    assert rejected.count() == len(bad) and valid.count() == 50 - len(bad)


def test_labels_fold_like_full_case_folding(spark):
    """Two characters, or words of them, clash exactly if Unicode folds them alike."""
    found = [chr(i) for i in range(32, 0x1F000) if not 0xD800 <= i < 0xE000 and chr(i).isprintable()]
    found += ["Straße", "STRASSE", "strasse", "ΟΔΟΣ", "οδος", "οδοσ", "İstanbul", "istanbul", "ﬁn", "FIN"]
    table = spark.createDataFrame([(text,) for text in found], "text string")
    by_spark, by_rule = {}, {}
    for text, key in table.select("text", contract.folded(F.col("text"))).collect():
        by_spark.setdefault(key, set()).add(text)
        by_rule.setdefault(text.casefold(), set()).add(text)
    assert {frozenset(one) for one in by_spark.values()} == {frozenset(one) for one in by_rule.values()}


def test_folded_labels_clash_everywhere(spark):
    table = raw(spark, *({"order_id": f"o{i}", "category": "Straße" if i else "STRASSE"} for i in range(3)))
    report = {r["rule"]: r["violations"] for r in contract.contract_report(table).collect()}
    assert report[contract.CASEFOLD_RULE] == 1
    rejected = contract.quarantine(table)[1].collect()
    assert [(r["category"], r["violations"]) for r in rejected] == [("STRASSE", [contract.CASEFOLD_RULE])]
    assert contract.casefold_clashes(table).count() == 2
