from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ofertario.functions import display, jsonx, keys, scalars
from ofertario.operators import issuers

DOC = """{"s":"x","n":20,"f":20.5,"b":true,"o":{"i":1},"a":[1,"z",{"q":1}],"flat":[1,"z",null],
"nil":null,"brack":"[x] {y}","empty":""}"""


def doc():
    return F.parse_json(F.lit(DOC))


@pytest.mark.parametrize(
    "path,expected",
    [
        ("$.s", "x"),
        ("$.n", "20"),
        ("$.f", "20.5"),
        ("$.b", "true"),
        ("$.o", None),
        ("$.a", None),
        ("$.nil", None),
        ("$.none", None),
        ("$.brack", "[x] {y}"),
        ("$.empty", ""),
        ("$.o.i", "1"),
        ("$.a[1]", "z"),
        ("$", None),
    ],
)
def test_json_value_reads_scalars_only(spark, one, path, expected):
    assert one(jsonx.json_value(doc(), path)) == expected
    frame = spark.range(1).select(doc().alias("p"))
    assert jsonx.with_json_values(frame, "p", {"v": path}).first()["v"] == expected


def test_json_presence_tells_null_from_missing(one):
    assert one(jsonx.has_key(doc(), "$.nil")) is True
    assert one(jsonx.has_key(doc(), "$.none")) is False
    assert one(jsonx.has_keys(doc(), ["s", "o.i"])) is True
    assert one(jsonx.has_keys(doc(), ["s", "o.j"])) is False
    assert one(jsonx.has_keys(doc(), ["none", "s"], "or")) is True


def test_json_arrays(one):
    assert one(jsonx.json_array_size(doc(), "$.a")) == 3
    assert one(jsonx.json_array_size(doc(), "$.o")) is None
    assert one(jsonx.json_value_array(doc(), "$.flat")) == ["1", "z", None]
    assert one(jsonx.json_value_array(doc(), "$.a")) is None
    assert one(jsonx.json_text(doc(), "$.o")) == '{"i":1}'


@pytest.mark.parametrize(
    "make,expected",
    [
        (lambda: scalars.trim_ws(F.lit("\t a b \n")), "a b"),
        (lambda: scalars.initcap_words(F.lit("coca-cola  ZERO (light)")), "Coca-Cola  Zero (Light)"),
        (lambda: scalars.safe_double(F.lit("5d")), None),
        (lambda: scalars.safe_double(F.lit(" 5.5 ")), 5.5),
        (lambda: scalars.safe_double(F.lit("50000,00")), None),
        (lambda: scalars.safe_bigint(F.lit("6.0")), None),
        (lambda: scalars.safe_bigint(F.lit("-1")), -1),
        (lambda: scalars.safe_bigint(F.lit("99999999999999999999")), None),
        (lambda: scalars.safe_bool(F.lit("TRUE")), True),
        (lambda: scalars.safe_bool(F.lit("yes")), None),
        (lambda: scalars.safe_bool(F.lit("1")), None),
        (lambda: scalars.greatest_or_null(F.lit(None).cast("bigint"), 0), None),
        (lambda: scalars.greatest_or_null(F.lit(-1).cast("bigint"), 0), 0),
        (lambda: scalars.extract(F.lit("abc"), r"(\d+)"), None),
        (lambda: scalars.extract(F.lit("a12"), r"(\d+)"), "12"),
        (lambda: scalars.parse_day(F.lit("2/6/2025"), "d/M/yyyy"), dt.date(2025, 6, 2)),
        (lambda: scalars.parse_day(F.lit("bad"), "d/M/yyyy"), None),
    ],
)
def test_scalar_rules(one, make, expected):
    assert one(make()) == expected


def test_strict_dates_fail(spark):
    from pyspark.errors import PySparkException

    frame = spark.createDataFrame([("bad",)], "v string")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    with pytest.raises(PySparkException):
        frame.select(scalars.parse_day("v", "d/M/yyyy", strict=True)).collect()


def test_keys_tell_null_from_text(one):
    null = F.lit(None).cast("string")
    assert one(keys.surrogate_key(null, F.lit("a"))) != one(keys.surrogate_key(F.lit(""), F.lit("a")))
    assert one(keys.number_list_text(F.array(F.lit(10), F.lit(9)))) == "9,10"
    assert one(keys.number_list_text(F.lit(None).cast("array<bigint>"))) == ""


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from(["a", "b", None, "c"]), max_size=5), st.randoms())
def test_list_text_ignores_order(one, values, random):
    shuffled = list(values)
    random.shuffle(shuffled)

    def text(items):
        structs = [F.struct(F.lit(i).cast("string").alias("t")) for i in items]
        array = F.array(*structs) if structs else F.array().cast("array<struct<t:string>>")
        return one(keys.struct_list_text(array))

    assert text(values) == text(shuffled)


@pytest.mark.parametrize(
    "rate,expected",
    [(0.125, "12%"), (0.0, "-"), (None, "-"), (0.285, "28%"), (0.2, "20%"), (0.005, "0%")],
)
def test_percent_text(one, rate, expected):
    assert one(display.percent_text(F.lit(rate).cast("double"))) == expected


def methods(*entries):
    kind = "array<struct<type:string,card_network:string,card_tier:string>>"
    if not entries:
        return F.array().cast(kind)
    return F.array(
        *[
            F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(("type", "card_network", "card_tier"), e)])
            for e in entries
        ]
    )


def test_payment_texts(one):
    listed = methods(
        ("credit_card", "visa", "Standard"),
        ("debit_card", "all", "all"),
        ("credit_card", "amex", " "),
        ("account_money", None, None),
        (None, None, None),
        ("credit_card", "visa", "Standard"),
    )
    assert one(display.payment_text(listed)) == (
        "Tarjeta de crédito visa Standard, Tarjeta de débito Todas, Tarjeta de crédito amex, "
        "Dinero en cuenta"
    )
    assert one(display.payment_groups_text(listed)) == (
        "Tarjeta de crédito (visa Standard, amex), Tarjeta de débito (Todas), Dinero en cuenta"
    )
    assert one(display.payment_types(listed)) == [
        "Tarjeta de crédito",
        "Tarjeta de débito",
        "Dinero en cuenta",
    ]
    for nothing in (methods(), F.lit(None).cast("array<struct<type:string,card_network:string,card_tier:string>>")):
        assert one(display.payment_text(nothing)) == "-"
        assert one(display.payment_groups_text(nothing)) == "-"
        assert one(display.payment_types(nothing)) == []


def test_day_texts(one):
    days = F.lit([4, 0, 9, None]).cast("array<bigint>")
    assert one(display.valid_days_text(days)) == "Lunes, Viernes"
    assert one(display.day_names(days)) == ["Vie", "Lun"]
    assert one(display.valid_days_text(F.lit(list(range(7))).cast("array<bigint>"))) == "Todos"
    assert one(display.valid_days_text(F.lit(None).cast("array<bigint>"))) == "-"


def test_small_labels(one):
    assert one(display.truncate_text(F.lit(" abcdef "), 3)) == "abc..."
    assert one(display.truncate_text(F.lit(None).cast("string"))) == ""
    assert one(display.day_text(F.lit(None).cast("date"))) == "N/A"
    assert one(display.cap_text(F.lit(1999.9))) == "$1999"
    assert one(display.minimum_text(F.lit(0.0))) == "Sin mínimo"
    assert one(display.validity(F.lit(None).cast("boolean"), F.lit(True))) == "Solo Presencial"
    assert one(display.with_suffix(F.lit("3"), " cuotas")) == "3 cuotas"
    assert one(display.with_suffix(F.lit("-"), " cuotas")) == "-"


def test_plain_key(one):
    assert one(issuers.plain_key(F.lit(" Banco  ÁÉÍ-Ñandú! "))) == "bancoaeinandu"
    assert one(issuers.plain_key(F.lit(None).cast("string"))) == ""
