from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from payloads import BBVA, GALICIA, NARANJAX, changed

from ofertario.operators import conform, mapping, normalize
from ofertario.sources import seeds


def bbva(raw, **fields):
    return normalize.normalize_bbva(raw("bbva", changed(BBVA, **fields))).first()


def galicia(raw, **fields):
    return normalize.normalize_galicia(raw("galicia", changed(GALICIA, **fields))).first()


def naranjax(raw, **fields):
    return normalize.normalize_naranjax(raw("naranjax", changed(NARANJAX, **fields))).first()


def tuples(methods):
    return None if methods is None else [tuple(m) for m in methods]


def test_staging_schema_is_the_same_for_all(raw):
    frames = [
        normalize.normalize_bbva(raw("bbva", BBVA)),
        normalize.normalize_galicia(raw("galicia", GALICIA)),
        normalize.normalize_naranjax(raw("naranjax", NARANJAX)),
    ]
    for frame in frames:
        assert {n: t.replace(" ", "") for n, t in frame.dtypes} == {
            n: t.replace(" ", "") for n, t in conform.STAGING_TYPES.items()
        }
    assert conform.union_sources(frames).count() == 3


@pytest.mark.parametrize(
    "headline,merchant",
    [
        ("Starbucks 20% de descuento", "Starbucks"),
        ("Pasion Beneficio exclusivo MODO", "Pasion"),
        ("Coto 6 cuotas sin interés", "Coto"),
        ("7 Eleven 15,5 % off", "7 Eleven"),
        ("Simple", "Simple"),
        ("Two\nlines", "Two\nlines"),
    ],
)
def test_bbva_merchant(raw, headline, merchant):
    assert bbva(raw, cabecera=headline).merchant_name == merchant


@pytest.mark.parametrize(
    "fields,rate",
    [
        ({}, 0.2),
        ({"cabecera": "A", "subcabecera": "15,5% off"}, 0.155),
        ({"cabecera": "A", "basesCondiciones": "un 30 % de reintegro"}, 0.3),
        ({"cabecera": "A", "basesCondiciones": "un 30 % TNA"}, 0.0),
        (
            {"cabecera": "A", "beneficios": [{"requisitos": ["30% Jueves en pases"]}]},
            0.3,
        ),
        ({"cabecera": "A"}, 0.0),
        ({"cabecera": "A", "beneficios": ...}, 0.0),
    ],
)
def test_bbva_rate(raw, fields, rate):
    assert bbva(raw, **fields).discount_rate == rate


@pytest.mark.parametrize(
    "terms,minimum",
    [
        ("compras superiores a $50.000", 50000.0),
        ("Mayores a $35000", 35000.0),
        ("mayores a $50.000,00", 0.0),
        ("sin minimo", 0.0),
    ],
)
def test_bbva_minimum(raw, terms, minimum):
    assert bbva(raw, basesCondiciones=terms).discount_min_purchase_amount == minimum


@pytest.mark.parametrize(
    "days,expected",
    [("1,0,1,0,1,0,0", [0, 2, 4]), (None, list(range(7))), ("", []), (" 1,1", [1])],
)
def test_bbva_days(raw, days, expected):
    assert bbva(raw, diasPromo=days).discount_valid_days_list == expected


def test_bbva_benefit_numbers(raw):
    assert bbva(raw).discount_no_interest_installment_qty == 6
    assert bbva(raw, beneficios=[{"cuota": -1}]).discount_no_interest_installment_qty == 0
    assert bbva(raw, beneficios=[]).discount_no_interest_installment_qty is None
    assert bbva(raw, beneficios=[{"tope": " 10.000 "}]).discount_max_discount_amount == 10.0
    assert bbva(raw, beneficios=[{"tope": ""}]).discount_max_discount_amount == 0.0


def test_bbva_channels(raw):
    row = bbva(raw)
    assert (row.discount_valid_online, row.discount_valid_instore) == (True, False)
    row = bbva(raw, esModo=True)
    assert (row.discount_valid_online, row.discount_valid_instore) == (False, True)
    assert bbva(raw, canalesVenta__web=...).discount_valid_online is None


def test_bbva_methods_and_keys(raw):
    row = bbva(raw, grupoTarjeta="Tarjetas de crédito y débito BBVA")
    assert tuples(row.discount_payment_methods_list) == [
        ("credit_card", "all", "all"),
        ("debit_card", "all", "all"),
    ]
    assert bbva(raw, grupoTarjeta="Otra").discount_payment_methods_list == []
    assert row.source_id == "7"
    assert row.discount_url.endswith("?id=7")
    assert bbva(raw, source_id=None).discount_url is None
    assert row.discount_end_date == dt.date(2025, 12, 31)
    assert bbva(raw, discount_end_date="x").discount_end_date is None


def test_galicia_numbers_keep_their_nulls(raw):
    row = galicia(raw)
    assert (row.discount_rate, row.discount_max_discount_amount) == (0.2, 5000.0)
    assert (row.discount_min_purchase_amount, row.discount_no_interest_installment_qty) == (0.0, 0)
    blank = galicia(raw, porcentajeAhorro=" ", topeReintegro="")
    assert (blank.discount_rate, blank.discount_max_discount_amount) == (None, None)
    assert galicia(raw, porcentajeAhorro=12.345).discount_rate == 0.1235


def test_galicia_names_and_dates(raw):
    row = galicia(raw)
    assert (row.merchant_name, row.merchant_category_name) == ("Coto", "Supermercados")
    assert row.discount_url.endswith("/promocion/g1|Coto|marca|")
    row = galicia(raw, tipoPromocion="Categoria")
    assert (row.merchant_name, row.merchant_category_name) == ("Bares", "Bares")
    assert row.discount_url.endswith("/promocion/g1|Bares|categoria|")
    assert row.discount_end_date == dt.date(2025, 6, 2)
    assert row.discount_name is None


@pytest.mark.parametrize(
    "days,expected", [("Lu;Mi;Vi", [0, 2, 4]), ("Lu;XX;Lu", [0, 0]), (None, [])]
)
def test_galicia_days(raw, days, expected):
    assert galicia(raw, diasAplicacion=days).discount_valid_days_list == expected


def test_galicia_channels(raw):
    assert galicia(raw).discount_valid_instore is False
    assert galicia(raw, leyendaCompra="En Comercios Adheridos").discount_valid_instore is True
    assert galicia(raw, leyendaCompra=None).discount_valid_instore is None
    assert galicia(raw, tiendaOnline=None).discount_valid_online is None


def test_galicia_methods(raw):
    visa = {"tarjeta": "Tarjeta Visa", "tipoTarjeta": "Credito"}
    row = galicia(raw, mediosDePago=[visa, {"tarjeta": "Otra"}])
    assert tuples(row.discount_payment_methods_list) == [
        ("credit_card", "visa", "Standard"),
        (None, None, None),
    ]
    assert galicia(raw, mediosDePago=[]).discount_payment_methods_list is None
    assert galicia(raw, mediosDePago=None).discount_payment_methods_list is None


@pytest.mark.parametrize(
    "name,quantity",
    [
        ("Plan Z", 3),
        ("6 cuotas cero interés", 6),
        ("1 cuota sin interés", 1),
        ("6 CUOTAS CERO INTERÉS", 0),
        ("Descuento", 0),
    ],
)
def test_naranjax_installments(raw, name, quantity):
    assert naranjax(raw, benefitName=name).discount_no_interest_installment_qty == quantity


def test_naranjax_numbers_and_days(raw):
    row = naranjax(raw)
    assert (row.discount_rate, row.discount_max_discount_amount) == (0.15, 0.0)
    assert row.discount_min_purchase_amount == 100.0
    assert row.discount_valid_days_list == [0, 2, 4]
    assert naranjax(raw, benefit__discountPercentage=None).discount_rate == 0.0
    assert naranjax(raw, days__weekdaysApplied=[1, "x"]).discount_valid_days_list == [0, None]
    assert naranjax(raw, days__weekdaysApplied=None).discount_valid_days_list == []


def test_naranjax_channels(raw):
    off = {"promotionDetails__appliesInStore": False}
    assert naranjax(raw, **off, commerces=...).discount_valid_instore is None
    assert naranjax(raw, **off, commerces=[]).discount_valid_instore is False
    assert naranjax(raw, **off, commerces=[{}]).discount_valid_instore is True
    assert naranjax(raw, promotionDetails__appliesOnline=None).discount_valid_online is False


def test_naranjax_methods_and_required_keys(raw):
    row = naranjax(raw, paymentMethods=["dinero", "credito", "x"])
    assert tuples(row.discount_payment_methods_list) == [
        ("account_money", None, None),
        ("credit_card", "naranja", "Standard"),
        (None, None, None),
    ]
    assert naranjax(raw, paymentMethods=[]).discount_payment_methods_list is None
    assert naranjax(raw, benefitName=...) is None
    assert naranjax(raw, days__weekdaysApplied=...) is None
    assert naranjax(raw, benefitName=None) is not None


def test_payment_seed_from_a_frame(spark, raw):
    dim = seeds.read_seed(spark, "naranja_payment_methods")
    frame = raw("naranjax", NARANJAX)
    built_in = normalize.normalize_naranjax(frame).first()
    given = normalize.normalize_naranjax(frame, methods=dim).first()
    assert built_in.discount_payment_methods_list == given.discount_payment_methods_list


def mapped_both_ways(spark, size, as_list):
    """Entries by row for a dimension of ``size`` rows: through arrays, and of one key."""
    data = [(str(i % 5), None if i % 3 == 0 else f"a{size - i}", f"b{i % 2}") for i in range(size)]
    data.append((None, "never", "found"))
    dim = data if as_list else spark.createDataFrame(data, "k string, x string, y string")
    rows = spark.createDataFrame(
        [(1, [4, 0, 9]), (1, [4, 0, 9]), (2, []), (3, None), (None, [None, 3]), (None, [3])],
        "id bigint, ks array<bigint>",
    )
    names = ["x", "y"]
    elements = mapping.map_elements(rows, "m", "ks", lambda k: [k], dim, ["k"], names, names)
    values = mapping.map_value(rows, "m", [F.col("id")], dim, ["k"], names, names)
    key = lambda r: (r.id or 0, str(r.ks))
    return [
        [(r.id, r.ks, r.m and [tuple(e) for e in r.m]) for r in sorted(df.collect(), key=key)]
        for df in (elements, values)
    ]


@pytest.mark.parametrize("as_list", [True, False])
@pytest.mark.parametrize("size", [8, 255, 256, 257, 600])
def test_dimensions_of_every_size_map_alike(spark, size, as_list):
    data = [(str(i % 5), None if i % 3 == 0 else f"a{size - i}", f"b{i % 2}") for i in range(size)]

    def of(key):
        entries = [(x, y) for k, x, y in data if k == str(key)]
        return sorted(entries, key=lambda e: [(v is not None, v or "") for v in e])

    def all_of(keys):
        return [e for k in keys for e in (of(k) or [(None, None)])] or None

    elements, values = mapped_both_ways(spark, size, as_list)
    assert elements == [(i, ks, all_of(ks or [])) for i, ks, _ in elements]
    assert values == [(i, ks, of(i)) for i, ks, _ in values]
    assert [i for i, _, _ in elements].count(1) == 2


@pytest.mark.parametrize(
    "rate,quantity,instore,online,kept",
    [
        (0.1, 0, True, None, True),
        (0.0, 3, None, True, True),
        (None, 0, True, True, False),
        (0.0, None, True, True, False),
        (None, 3, True, False, True),
        (0.1, 0, False, None, False),
        (0.1, 0, False, False, False),
    ],
)
def test_worth_showing(spark, rate, quantity, instore, online, kept):
    frame = spark.createDataFrame(
        [(rate, quantity, instore, online)],
        "discount_rate double, discount_no_interest_installment_qty bigint,"
        "discount_valid_instore boolean, discount_valid_online boolean",
    )
    assert (conform.keep_worth_showing(frame).count() == 1) is kept
