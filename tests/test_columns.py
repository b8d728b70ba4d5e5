from decimal import Decimal
from datetime import date

from pyspark.sql import functions as F

from stratagate import vocabulary as v
from stratagate.contract import Field, Labels
from stratagate.functions import convert, text


def values(spark, rows, column):
    df = spark.createDataFrame([(r,) for r in rows], "c string")
    return [r[0] for r in df.select(column).collect()]


def test_trim_takes_blanks_only(spark):
    assert values(spark, [" a ", "\ta", None], text.trim_ends(F.col("c"))) == ["a", "\ta", None]


def test_digits_upper_empty(spark):
    assert values(spark, ["1-2a", None], text.digits_only(F.col("c"))) == ["12", None]
    assert values(spark, ["ab", None], text.upper_case(F.col("c"))) == ["AB", None]
    assert values(spark, ["", "x", None], text.empty_to_null(F.col("c"))) == [None, "x", None]


def test_null_if(spark):
    step = text.null_if("0", "00")
    assert values(spark, ["0", "00", "000", None], step(F.col("c"))) == [None, None, "000", None]


def test_pad_left_never_truncates(spark):
    step = text.pad_left(3, "0")
    assert values(spark, ["1", "123", "12345", "", None], step(F.col("c"))) == [
        "001", "123", "12345", "000", None,
    ]


def test_steps_run_in_order(spark):
    steps = [text.digits_only, text.empty_to_null, text.pad_left(4, "0")]
    assert values(spark, ["a1", "abc"], text.apply_all(F.col("c"), steps)) == ["0001", None]


def test_numbers(spark):
    assert values(spark, ["7", "1.5", "x", "3000000000"], convert.to_number(F.col("c"), "int")) == [
        7, None, None, None,
    ]
    assert values(spark, ["3000000000", None], convert.to_number(F.col("c"), "bigint")) == [3000000000, None]
    got = values(spark, ["12,345", "1.234,56", "x", "1"], convert.to_number(F.col("c"), "decimal(10,2)", ","))
    assert got == [Decimal("12.35"), None, None, Decimal("1.00")]


def test_dates(spark):
    assert values(spark, ["20260901", "20261332", "2026-9-1"], convert.to_date(F.col("c"), "AAAAMMDD")) == [
        date(2026, 9, 1), None, None,
    ]
    assert values(spark, ["2026-09-01", "2026-9-1"], convert.to_date(F.col("c"), "AAAA-MM-DD")) == [
        date(2026, 9, 1), None,
    ]
    assert values(spark, ["01/09/2026"], convert.to_date(F.col("c"), "DD/MM/AAAA")) == [date(2026, 9, 1)]


def test_label(spark):
    assert values(spark, ["A", "Z", None], convert.label_of(F.col("c"), {"A": "Ativo"})) == ["Ativo", None, None]


def test_labels_of_typed_codes(spark):
    labels = Labels({"1": "One", "02": "Two", "x": "never"}, "label")
    for kind, typed in ((v.INTEGER, "int"), (v.LONG, "bigint")):
        f = Field("c", kind, header="C", domain=labels)
        df = spark.createDataFrame([(1,), (2,), (3,), (None,)], f"c {typed}")
        rows = df.select(f.label(F.col("c")).alias("label"), f.listed(F.col("c")).alias("known"))
        assert [tuple(r) for r in rows.collect()] == [
            ("One", True), ("Two", True), (None, False), (None, False),
        ]
