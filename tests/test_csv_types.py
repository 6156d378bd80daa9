"""Types inferred from CSV texts against those that pandas gives."""
import os
import tempfile

import pandas as pd
import pytest

from tessera.sources.csv import inferred_types, read_csv, read_text_columns

KINDS = {"int64": "bigint", "uint64": "decimal(20,0)", "float64": "double", "bool": "boolean", "object": "string", "str": "string"}
COLUMNS = {
    "whole": ["1", "-2", "+3", "007"],
    "gap": ["1", "", "3", "NA"],
    "real": ["1", "2.5", "-3e4", ".5"],
    "real_gap": ["1.", "NaN", "n/a", "2E-3"],
    "endless": ["1", "inf", "-Infinity", "2.0"],
    "none": ["", "NA", "null", "None"],
    "truth": ["True", "false", "TRUE", "False"],
    "truth_gap": ["True", "", "TRUE", "False"],
    "mixed": ["True", "1", "0", "False"],
    "text": ["1", "x", "3", "4"],
    "late": ["1", "2", "3", "4a"],
    "big": ["9223372036854775807", "-9223372036854775808", "0", "1"],
    "wide": ["9223372036854775808", "18446744073709551615", "0", "1"],
    "wide_signed": ["9223372036854775808", "-1", "0", "1"],
    "dates": ["2020-01-01", "2020-01-02", "2020-01-03", "2020-01-04"],
    "hex": ["0x1", "0x2", "0x3", "0x4"],
    "suffix": ["1d", "2f", "3", "4"],
    "dot.name": ["1", "2", "3", "4"],
    "quoted": ['"1,5"', '"a ""b"""', "c", "d"],
}


@pytest.fixture(scope="module")
def path():
    p = os.path.join(tempfile.mkdtemp(prefix="tessera-csv-"), "t.csv")
    with open(p, "w") as f:
        f.write(",".join(COLUMNS) + "\n")
        for row in zip(*COLUMNS.values()):
            f.write(",".join(row) + "\n")
    return p


def test_types_and_values_equal_pandas(spark, path):
    theirs = pd.read_csv(path)
    want = {c: KINDS[str(t)] for c, t in theirs.dtypes.items()}
    assert want["truth_gap"] == "string" and theirs["truth_gap"].dropna().map(type).eq(bool).all()
    want["truth_gap"] = "boolean"  # an object column of bools there, since its bool column has no missing value
    found = inferred_types(read_text_columns(spark, path)).collect()
    assert {r["col_name"]: r["type"] for r in found} == want
    assert {r["col_name"]: r["n_null"] for r in found} == {c: int(n) for c, n in theirs.isna().sum().items()}
    ours = read_csv(spark, path)
    assert {f.name: f.dataType.simpleString() for f in ours.schema.fields} == want
    for c in COLUMNS:
        got = [r[0] for r in ours.select(f"`{c}`").collect()]
        expected = [None if pd.isna(v) else v for v in theirs[c].tolist()]
        if want[c] == "string":
            got, expected = [None if v is None else str(v) for v in got], [None if v is None else str(v) for v in expected]
        assert got == expected, c


def test_header_without_rows(spark):
    p = os.path.join(tempfile.mkdtemp(prefix="tessera-csv-"), "t.csv")
    with open(p, "w") as f:
        f.write("a,b\n")
    assert [(r["col_name"], r["type"], r["n_null"]) for r in inferred_types(read_text_columns(spark, p)).collect()] == [
        ("a", "string", 0), ("b", "string", 0)]
    assert read_csv(spark, p).count() == 0


def test_own_tokens(spark, path):
    types = {r["col_name"]: r["type"] for r in inferred_types(read_text_columns(spark, path).select("gap"), ["NA"]).collect()}
    assert types == {"gap": "double"}  # an empty field is null to the reader itself


def test_one_pass_without_a_shuffle_of_rows(spark, path):
    plan = inferred_types(read_text_columns(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1 and ("partial_bool_and" in plan or "partial_min" in plan)
