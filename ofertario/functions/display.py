"""What a reader sees of an offer, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .scalars import trim_ws

# Short and full day names, Monday first.
DAY_SHORT = ["Lun", "Mar", "Mié", "Jue", "Vie", "Sáb", "Dom"]
DAY_FULL = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]

# Payment types and their labels.
TYPE_LABELS = {
    "credit_card": "Tarjeta de crédito",
    "debit_card": "Tarjeta de débito",
    "account_money": "Dinero en cuenta",
}

# Words for whole, empty, absent and unknown values.
ALL_DAYS = "Todos"
ALL_CARDS = "Todas"
NOTHING = "-"
UNKNOWN = "N/A"
NO_MINIMUM = "Sin mínimo"
NO_CAP = "Sin tope"

# Where an offer is valid.
VALID_BOTH = "Online y Presencial"
VALID_ONLINE = "Solo Online"
VALID_INSTORE = "Solo Presencial"
VALID_UNKNOWN = "Ver legales"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _names(names: list[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def day_names(days) -> Column:
    """Short names in the order given; numbers outside the week are dropped."""
    week = F.filter(_col(days), lambda d: d.between(0, 6))
    named = F.transform(week, lambda d: F.element_at(_names(DAY_SHORT), (d + 1).cast("int")))
    return F.coalesce(named, F.array().cast("array<string>"))


def valid_days_text(days) -> Column:
    """Full names, Monday first; one word for all seven."""
    days = _col(days)
    week = F.filter(
        F.sequence(F.lit(0), F.lit(6)),
        lambda i: F.coalesce(F.array_contains(days, i.cast("bigint")), F.lit(False)),
    )
    full = F.transform(week, lambda i: F.element_at(_names(DAY_FULL), i + 1))
    return (
        F.when(F.size(week) == 7, F.lit(ALL_DAYS))
        .when(F.size(week) == 0, F.lit(NOTHING))
        .otherwise(F.array_join(full, ", "))
    )


def validity(online, instore) -> Column:
    """Unknown counts as no."""
    return (
        F.when(_col(online) & _col(instore), F.lit(VALID_BOTH))
        .when(_col(online), F.lit(VALID_ONLINE))
        .when(_col(instore), F.lit(VALID_INSTORE))
        .otherwise(F.lit(VALID_UNKNOWN))
    )


def percent_text(rate) -> Column:
    """Whole percent, halves to even."""
    rate = _col(rate)
    whole = F.bround(rate * 100).cast("bigint").cast("string")
    return F.when(rate > 0, F.concat(whole, F.lit("%"))).otherwise(F.lit(NOTHING))


def installments_text(quantity) -> Column:
    quantity = _col(quantity)
    whole = quantity.cast("bigint").cast("string")
    return F.when(quantity > 0, whole).otherwise(F.lit(NOTHING))


def amount_text(amount, none: str) -> Column:
    """``none`` for zero, the amount without cents otherwise."""
    amount = _col(amount)
    return (
        F.when(amount.isNull(), F.lit(UNKNOWN))
        .when(amount == 0, F.lit(none))
        .otherwise(F.concat(F.lit("$"), amount.cast("bigint").cast("string")))
    )


def minimum_text(amount) -> Column:
    return amount_text(amount, NO_MINIMUM)


def cap_text(amount) -> Column:
    return amount_text(amount, NO_CAP)


def with_suffix(value, suffix: str) -> Column:
    value = _col(value)
    return F.when(value == NOTHING, value).otherwise(F.concat(value, F.lit(suffix)))


def type_label(kind: Column) -> Column:
    """The label of a payment type, an unknown type itself, '' for none."""
    label = F
    for name, text in TYPE_LABELS.items():
        label = label.when(kind == name, F.lit(text))
    return F.coalesce(label.otherwise(kind), F.lit(""))


def _details(method: Column) -> list[Column]:
    """Network and tier as shown; NULL for one that is missing or blank."""

    def shown(field: Column) -> Column:
        return F.when(trim_ws(field) != "", F.when(field == "all", F.lit(ALL_CARDS)).otherwise(field))

    return [shown(method["card_network"]), shown(method["card_tier"])]


def _joined(parts: list[Column]) -> Column:
    """The parts that say something, each once, parted by spaces."""
    said = F.filter(F.array_distinct(F.array(*parts)), lambda p: p.isNotNull() & (p != ""))
    return F.array_join(said, " ")


def _nonempty(texts: Column) -> Column:
    return F.array_distinct(F.filter(texts, lambda t: t != ""))


def _dash_if_empty(text: Column) -> Column:
    return F.when(text != "", text).otherwise(F.lit(NOTHING))


def payment_types(methods) -> Column:
    """The distinct type labels, first seen first."""
    labels = _nonempty(F.transform(_col(methods), lambda m: type_label(m["type"])))
    return F.coalesce(labels, F.array().cast("array<string>"))


def payment_text(methods) -> Column:
    """Each distinct method as ``type network tier``."""
    labels = F.transform(
        _col(methods), lambda m: _joined([type_label(m["type"]), *_details(m)])
    )
    return _dash_if_empty(F.array_join(_nonempty(labels), ", "))


def payment_groups_text(methods) -> Column:
    """Methods grouped by type: ``Type (detail, detail), Type``."""
    methods = _col(methods)

    def group(label: Column) -> Column:
        members = F.filter(methods, lambda m: type_label(m["type"]) == label)
        details = _nonempty(F.transform(members, lambda m: _joined(_details(m))))
        listed = F.array_join(details, ", ")
        return F.when(listed != "", F.concat(label, F.lit(" ("), listed, F.lit(")"))).otherwise(label)

    return _dash_if_empty(F.array_join(F.transform(payment_types(methods), group), ", "))


def truncate_text(text, length: int = 150) -> Column:
    """At most ``length`` characters and an ellipsis; NULL is ''."""
    text = trim_ws(text)
    cut = F.when(
        F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))
    ).otherwise(text)
    return F.coalesce(cut, F.lit(""))


def day_text(date) -> Column:
    return F.coalesce(F.date_format(_col(date), "dd/MM/yyyy"), F.lit(UNKNOWN))


def with_display_columns(df: DataFrame) -> DataFrame:
    """The serving table with everything a result card shows."""
    return df.withColumns(
        {
            "valid_days_names": day_names("discount_valid_days_list"),
            "valid_days_text": valid_days_text("discount_valid_days_list"),
            "formato": validity("discount_valid_online", "discount_valid_instore"),
            "rate_text": percent_text("discount_rate"),
            "installments_text": installments_text("discount_no_interest_installment_qty"),
            "minimum_text": minimum_text("discount_min_purchase_amount"),
            "cap_text": cap_text("discount_max_discount_amount"),
            "payment_method_types": payment_types("discount_payment_methods_list"),
            "payment_text": payment_text("discount_payment_methods_list"),
            "payment_groups_text": payment_groups_text("discount_payment_methods_list"),
            "start_text": day_text("discount_start_date"),
            "end_text": day_text("discount_end_date"),
        }
    )
