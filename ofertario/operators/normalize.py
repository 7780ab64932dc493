"""Each source's payloads to the one uniform staging schema.

Every rule first pulls the texts it needs out of the payload once; the rest is
column arithmetic on those texts, so a source is one scan stage without a
shuffle. Flags, rates and installments keep the NULLs their source gives them:
the business filter tells NULL from zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import jsonx, scalars
from ..sources import seed_values
from .conform import conform
from .mapping import map_elements, map_value

METHOD = ["type", "card_network", "card_tier"]
_PARSED = ["parsed_type", "parsed_card_network", "parsed_card_tier"]

# Issuer names, addresses and text patterns of the sources.
BBVA_ISSUER = "Banco BBVA"
BBVA_URL = "https://www.bbva.com.ar/beneficios/beneficio.html?id="
BBVA_ANNOTATION = (
    r"(?id)\s+(?:\d+(?:[.,]\d+)?\s*(?:%|cuotas)|Beneficio|descuento|exclusivo).*\z"
)
BBVA_PERCENT = r"(\d+(?:[.,]\d+)?)\s*%"
BBVA_PERCENT_OFF = r"(?i)(\d+(?:[.,]\d+)?)\s*%\s*de\s*(?:reintegro|descuento)"
BBVA_MINIMUM = r"(?i)(?:superiores?|mayores?)\s+a\s+\$\s*([\d.,]+)"
GALICIA_ISSUER = "Banco Galicia"
GALICIA_URL = "https://galicia.ar/personas/buscador-de-promociones?path=/promocion/"
GALICIA_DAYS = ["Lu", "Ma", "Mi", "Ju", "Vi", "Sa", "Do"]
GALICIA_SHOPS = r"(?i)comercios adheridos"
NARANJA_ISSUER = "Naranja X"
NARANJA_PLAN_Z = r"(?i)plan z"
NARANJA_INSTALLMENTS = r"(\d+)\s+cuotas?\s+(?:cero|sin)\s+inter"


def _payloads(raw: DataFrame, source: str, paths: dict[str, str]) -> DataFrame:
    """The source's rows with each path's scalar text under its own name."""
    own = raw.filter(F.col("spider") == source).select(
        F.col("raw_payload").alias("discount_metadata"), "scraped_at_dt"
    )
    return jsonx.with_json_values(own, "discount_metadata", paths)


def _share(number: Column) -> Column:
    return F.round(number / 100, 4)


def _percent_in(text: str, pattern: str) -> Column:
    digits = F.replace(F.regexp_extract(text, pattern, 1), F.lit(","), F.lit("."))
    return _share(scalars.safe_double(digits))


def normalize_bbva(raw: DataFrame, methods=None, strict_dates: bool = False) -> DataFrame:
    """``methods``: a frame like the payment seed, the built-in one by default."""
    rows = _payloads(
        raw,
        "bbva",
        {
            "source_id": "$.source_id",
            "headline": "$.cabecera",
            "subheadline": "$.subcabecera",
            "terms": "$.basesCondiciones",
            "merchant_category_name": "$.category_name",
            "starts": "$.discount_start_date",
            "ends": "$.discount_end_date",
            "cap": "$.beneficios[0].tope",
            "installments": "$.beneficios[0].cuota",
            "days": "$.diasPromo",
            "modo": "$.esModo",
            "card_group": "$.grupoTarjeta",
        },
    )
    payload = "discount_metadata"
    rows = rows.withColumns(
        {
            "requirements": jsonx.json_text(payload, "$.beneficios[0].requisitos"),
            "benefits": jsonx.json_array_size(payload, "$.beneficios"),
            "web": jsonx.json_array_size(payload, "$.canalesVenta.web"),
            "branches": jsonx.json_array_size(payload, "$.canalesVenta.sucursales"),
            "modo": F.coalesce(scalars.safe_bool("modo"), F.lit(False)),
        }
    )

    # The first text that names a percentage decides, readable or not.
    places = [
        ("headline", BBVA_PERCENT),
        ("subheadline", BBVA_PERCENT),
        ("terms", BBVA_PERCENT_OFF),
        ("requirements", BBVA_PERCENT),
    ]
    rate = F
    for text, pattern in places:
        rate = rate.when(F.col(text).rlike(pattern), _percent_in(text, pattern))

    listed = F.col("benefits") > 0
    minimum = F.replace(F.regexp_extract("terms", BBVA_MINIMUM, 1), F.lit("."), F.lit(""))
    flagged = F.filter(
        F.transform(
            F.split("days", ","), lambda flag, i: F.when(flag == "1", i.cast("bigint"))
        ),
        lambda day: day.isNotNull(),
    )
    every_day = F.sequence(F.lit(0).cast("bigint"), F.lit(6).cast("bigint"))

    rows = rows.withColumns(
        {
            "issuer_name": F.lit(BBVA_ISSUER),
            "merchant_name": scalars.trim_ws(F.regexp_replace("headline", BBVA_ANNOTATION, "")),
            "discount_start_date": scalars.parse_day("starts", "yyyy-M-d", strict_dates),
            "discount_end_date": scalars.parse_day("ends", "yyyy-M-d", strict_dates),
            "discount_rate": F.coalesce(rate, F.lit(0.0)),
            "discount_name": F.col("headline"),
            "discount_description": F.col("subheadline"),
            "discount_terms_and_conditions": F.col("terms"),
            "discount_url": F.concat(F.lit(BBVA_URL), "source_id"),
            "discount_max_discount_amount": F.coalesce(
                F.when(listed, scalars.safe_double(scalars.trim_ws("cap"))), F.lit(0.0)
            ),
            "discount_min_purchase_amount": F.coalesce(
                F.when(F.col("terms").rlike(BBVA_MINIMUM), scalars.safe_double(minimum)),
                F.lit(0.0),
            ),
            "discount_no_interest_installment_qty": scalars.greatest_or_null(
                F.when(listed, scalars.safe_bigint("installments")), 0
            ),
            "discount_valid_days_list": F.when(F.col("days").isNull(), every_day).otherwise(
                flagged
            ),
            "discount_valid_online": F.when(F.col("modo"), False).otherwise(F.col("web") > 0),
            "discount_valid_instore": F.when(F.col("modo"), True).otherwise(
                F.col("branches") > 0
            ),
        }
    )
    dim = seed_values.BBVA_PAYMENT_METHODS if methods is None else methods
    return conform(
        map_value(
            rows,
            "discount_payment_methods_list",
            [F.col("card_group")],
            dim,
            ["raw_grupo_tarjeta"],
            _PARSED,
            METHOD,
        ),
        "bbva",
    )


def normalize_galicia(raw: DataFrame, methods=None, strict_dates: bool = False) -> DataFrame:
    rows = _payloads(
        raw,
        "galicia",
        {
            "source_id": "$.source_id",
            "kind": "$.tipoPromocion",
            "category": "$.categoria.descripcion",
            "brand": "$.marca.nombre",
            "brand_category": "$.marca.categoria.descripcion",
            "starts": "$.fechaDesde",
            "ends": "$.fechaHasta",
            "percent": "$.porcentajeAhorro",
            "discount_description": "$.descripcionAdicional",
            "discount_terms_and_conditions": "$.legales",
            "cap": "$.topeReintegro",
            "minimum": "$.minimoCompra",
            "installments": "$.cuotaSinInteresHasta",
            "days": "$.diasAplicacion",
            "online": "$.tiendaOnline",
            "instore": "$.tiendaFisica",
            "note": "$.leyendaCompra",
        },
    )
    by_category = F.col("kind") == "Categoria"
    place = F.when(by_category, F.concat("category", F.lit("|categoria|"))).otherwise(
        F.concat("brand", F.lit("|marca|"))
    )

    def amount(name: str) -> Column:
        return scalars.safe_decimal(scalars.trim_ws(name))

    day_number = F.create_map(
        *[part for i, day in enumerate(GALICIA_DAYS) for part in (F.lit(day), F.lit(i).cast("bigint"))]
    )
    days = F.transform(
        F.split(F.coalesce("days", F.lit("")), ";"), lambda d: F.try_element_at(day_number, d)
    )
    rows = rows.withColumns(
        {
            "issuer_name": F.lit(GALICIA_ISSUER),
            "merchant_name": F.when(by_category, F.col("category")).otherwise(F.col("brand")),
            "merchant_category_name": F.when(by_category, F.col("category")).otherwise(
                F.col("brand_category")
            ),
            "discount_start_date": scalars.parse_day("starts", "d/M/yyyy", strict_dates),
            "discount_end_date": scalars.parse_day("ends", "d/M/yyyy", strict_dates),
            "discount_rate": _share(amount("percent")).cast("double"),
            "discount_name": scalars.typed_null("string"),
            "discount_url": F.concat(F.lit(GALICIA_URL), "source_id", F.lit("|"), place),
            "discount_max_discount_amount": amount("cap").cast("double"),
            "discount_min_purchase_amount": F.coalesce(
                amount("minimum").cast("double"), F.lit(0.0)
            ),
            "discount_no_interest_installment_qty": F.coalesce(
                scalars.safe_bigint(scalars.trim_ws("installments")), F.lit(0)
            ),
            "discount_valid_days_list": F.filter(days, lambda d: d.isNotNull()),
            "discount_valid_online": scalars.safe_bool("online"),
            "discount_valid_instore": scalars.safe_bool("instore")
            | F.col("note").rlike(GALICIA_SHOPS),
            "_methods": jsonx.json_array("discount_metadata", "$.mediosDePago"),
        }
    )
    dim = seed_values.GALICIA_PAYMENT_METHODS if methods is None else methods
    return conform(
        map_elements(
            rows,
            "discount_payment_methods_list",
            "_methods",
            lambda m: [jsonx.json_value(m, "$.tarjeta"), jsonx.json_value(m, "$.tipoTarjeta")],
            dim,
            ["raw_tarjeta", "raw_tipoTarjeta"],
            _PARSED,
            METHOD,
        ),
        "galicia",
    )


def normalize_naranjax(raw: DataFrame, methods=None, strict_dates: bool = False) -> DataFrame:
    """Payloads that lack a required key are left out before anything is parsed."""
    sound = raw.filter(jsonx.has_keys("raw_payload", seed_values.REQUIRED_KEYS["naranjax"]))
    rows = _payloads(
        sound,
        "naranjax",
        {
            "source_id": "$.id",
            "merchant_name": "$.commerceName",
            "merchant_category_name": "$.category.name",
            "starts": "$.days.dateFrom",
            "ends": "$.days.dateTo",
            "percent": "$.benefit.discountPercentage",
            "discount_name": "$.benefitName",
            "discount_description": "$.subtitle",
            "discount_terms_and_conditions": "$.legal",
            "discount_url": "$.discount_url",
            "cap": "$.promotionDetails.refundLimit",
            "minimum": "$.promotionDetails.forPurchasesOver",
            "online": "$.promotionDetails.appliesOnline",
            "instore": "$.promotionDetails.appliesInStore",
        },
    )
    payload = "discount_metadata"
    benefit = F.col("discount_name")
    installments = F.when(benefit.rlike(NARANJA_PLAN_Z), F.lit(3).cast("bigint")).when(
        benefit.rlike(NARANJA_INSTALLMENTS),
        scalars.safe_bigint(F.regexp_extract(benefit, NARANJA_INSTALLMENTS, 1)),
    )
    days = F.transform(
        jsonx.json_array(payload, "$.days.weekdaysApplied"),
        lambda d: scalars.safe_bigint(jsonx.json_value(d)) - 1,
    )

    def or_zero(number: Column) -> Column:
        return F.coalesce(number, F.lit(0.0))

    def flag(name: str) -> Column:
        return F.coalesce(scalars.safe_bool(name), F.lit(False))

    rows = rows.withColumns(
        {
            "issuer_name": F.lit(NARANJA_ISSUER),
            "discount_start_date": scalars.parse_day("starts", "d/M/yyyy", strict_dates),
            "discount_end_date": scalars.parse_day("ends", "d/M/yyyy", strict_dates),
            "discount_rate": or_zero(_share(scalars.safe_double("percent"))),
            "discount_max_discount_amount": or_zero(scalars.safe_double("cap")),
            "discount_min_purchase_amount": or_zero(scalars.safe_double("minimum")),
            "discount_no_interest_installment_qty": F.coalesce(installments, F.lit(0)),
            "discount_valid_days_list": F.coalesce(days, F.array().cast("array<bigint>")),
            "discount_valid_online": flag("online"),
            "discount_valid_instore": flag("instore")
            | (jsonx.json_array_size(payload, "$.commerces") > 0),
            "_methods": jsonx.json_value_array(payload, "$.paymentMethods"),
        }
    )
    dim = seed_values.NARANJA_PAYMENT_METHODS if methods is None else methods
    return conform(
        map_elements(
            rows,
            "discount_payment_methods_list",
            "_methods",
            lambda m: [m],
            dim,
            ["raw_payment_method"],
            _PARSED,
            METHOD,
        ),
        "naranjax",
    )


NORMALIZERS = {
    "bbva": normalize_bbva,
    "galicia": normalize_galicia,
    "naranjax": normalize_naranjax,
}
