"""The supplied orders rendered as promotions in each source's payload shape.

One order is one raw record, scraped in the month of its order. The records are
written to a landing zone as JSON lines and read from there, so the queries run
on what the sources would leave. Rates move between the places a source may
state them, which makes every rule of the sources decide some rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SPIDERS = ["bbva", "galicia", "naranjax"]
# Offers that are valid in shops only end early, so a date between splits them.
START, END, END_EARLY = "1995-01-01", "2001-12-31", "2000-06-30"
_DAY_CODES = ["Lu", "Ma", "Mi", "Ju", "Vi", "Sa", "Do"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rendered promotion states, as plain columns."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    regions = table(spark, sf_dir, "region")
    key = F.col("o_orderkey")
    return (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.alias("seq"),
            F.col("o_custkey").cast("string").alias("source_id"),
            F.trunc("o_orderdate", "month").alias("scraped_at_dt"),
            F.col("c_mktsegment").alias("merchant"),
            F.col("r_name").alias("category"),
            ((key % 5) * 10).alias("percent"),
            ((key % 2) * 3).alias("installments"),
            F.col("o_orderstatus").alias("status"),
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("priority"),
            F.element_at(F.array(*[F.lit(s) for s in SPIDERS]), (key % 3 + 1).cast("int")).alias(
                "spider"
            ),
        )
    )


def _only(condition: Column, value: Column) -> Column:
    return F.when(condition, value).otherwise(F.lit(""))


def _one_if(condition: Column) -> Column:
    """An array of one element or of none."""
    return F.when(condition, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))


def _end(pattern: str) -> Column:
    end = F.when(F.col("status") == "O", F.lit(END_EARLY)).otherwise(F.lit(END))
    return F.date_format(F.to_date(end), pattern)


def bbva_payload() -> Column:
    percent = F.col("percent").cast("string")
    is_at = {p: F.col("percent") == p for p in (10, 20, 30, 40)}
    off = F.concat(F.lit(" "), percent, F.lit("% de descuento"))
    minimum = F.format_number(F.col("installments") * 5000, 0)
    flags = F.transform(
        F.sequence(F.lit(1), F.lit(7)),
        lambda d: F.when(d.isin(F.col("priority"), F.col("priority") + 1), "1").otherwise("0"),
    )
    return F.struct(
        F.col("seq"),
        F.col("source_id"),
        F.concat("merchant", _only(is_at[40], off)).alias("cabecera"),
        F.concat(F.lit("Oferta"), _only(is_at[10], off)).alias("subcabecera"),
        F.concat(
            F.lit("Bases."),
            _only(
                F.col("installments") > 0,
                F.concat(
                    F.lit(" Compras superiores a $"), F.replace(minimum, F.lit(","), F.lit("."))
                ),
            ),
            _only(is_at[20], F.concat(F.lit(" "), percent, F.lit("% de reintegro"))),
        ).alias("basesCondiciones"),
        F.col("category").alias("category_name"),
        F.lit(START).alias("discount_start_date"),
        _end("yyyy-MM-dd").alias("discount_end_date"),
        F.array(
            F.struct(
                (F.col("percent") * 100).cast("string").alias("tope"),
                F.col("installments").cast("string").alias("cuota"),
                F.array(
                    F.concat(F.lit("Requisito"), _only(is_at[30], F.concat(F.lit(" "), percent, F.lit("%"))))
                ).alias("requisitos"),
            )
        ).alias("beneficios"),
        F.array_join(flags, ",").alias("diasPromo"),
        F.struct(
            _one_if(F.col("status") == "F").alias("web"),
            _one_if(F.col("status") == "F").alias("sucursales"),
        ).alias("canalesVenta"),
        (F.col("status") == "O").alias("esModo"),
        F.lit("Tarjetas de crédito y débito BBVA").alias("grupoTarjeta"),
    )


def galicia_payload() -> Column:
    codes = F.array(*[F.lit(c) for c in _DAY_CODES])
    days = F.concat_ws(
        ";",
        F.element_at(codes, F.col("priority").cast("int")),
        F.element_at(codes, (F.col("priority") + 1).cast("int")),
    )
    return F.struct(
        F.col("seq"),
        F.col("source_id"),
        F.lit("Marca").alias("tipoPromocion"),
        F.struct(F.lit("-").alias("descripcion")).alias("categoria"),
        F.struct(
            F.col("merchant").alias("nombre"),
            F.struct(F.col("category").alias("descripcion")).alias("categoria"),
        ).alias("marca"),
        F.lit("01/01/1995").alias("fechaDesde"),
        _end("dd/MM/yyyy").alias("fechaHasta"),
        # Blank for no discount: this source has no rate then, not a rate of 0.
        _only(F.col("percent") > 0, F.col("percent").cast("string")).alias("porcentajeAhorro"),
        F.lit("Promo").alias("descripcionAdicional"),
        F.lit("Legales").alias("legales"),
        (F.col("percent") * 100).alias("topeReintegro"),
        (F.col("installments") * 5000).cast("string").alias("minimoCompra"),
        F.col("installments").cast("string").alias("cuotaSinInteresHasta"),
        days.alias("diasAplicacion"),
        (F.col("status") == "F").alias("tiendaOnline"),
        (F.col("status") == "F").alias("tiendaFisica"),
        _only(F.col("status") == "O", F.lit("En Comercios Adheridos")).alias("leyendaCompra"),
        F.array(
            F.struct(F.lit("Tarjeta Visa").alias("tarjeta"), F.lit("Credito").alias("tipoTarjeta"))
        ).alias("mediosDePago"),
    )


def naranjax_payload() -> Column:
    odd = F.col("seq") % 2 == 1
    forward = F.array(F.lit("credito"), F.lit("debito"))
    benefit = (
        F.when((F.col("installments") > 0) & (F.col("percent") == 20), F.lit("Plan Z"))
        .when(
            F.col("installments") > 0,
            F.concat(F.col("installments").cast("string"), F.lit(" cuotas cero interés")),
        )
        .otherwise(F.lit("Descuento"))
    )
    return F.struct(
        F.col("seq"),
        F.col("source_id").alias("id"),
        F.col("merchant").alias("commerceName"),
        F.struct(F.col("category").alias("name")).alias("category"),
        F.struct(
            F.lit("01/01/1995").alias("dateFrom"),
            _end("dd/MM/yyyy").alias("dateTo"),
            F.array("priority", F.col("priority") + 1).alias("weekdaysApplied"),
        ).alias("days"),
        F.struct(F.col("percent").alias("discountPercentage")).alias("benefit"),
        benefit.alias("benefitName"),
        F.lit("Promo").alias("subtitle"),
        F.lit("Legal").alias("legal"),
        F.lit("https://example.com/promo").alias("discount_url"),
        F.struct(
            (F.col("percent") * 100).alias("refundLimit"),
            (F.col("installments") * 5000).alias("forPurchasesOver"),
            (F.col("status") == "F").alias("appliesOnline"),
            (F.col("status") == "F").alias("appliesInStore"),
        ).alias("promotionDetails"),
        _one_if(F.col("status") == "O").alias("commerces"),
        F.when(odd, F.reverse(forward)).otherwise(forward).alias("paymentMethods"),
    )


PAYLOADS = {"bbva": bbva_payload, "galicia": galicia_payload, "naranjax": naranjax_payload}


def _parsed(payload: Column) -> Column:
    return F.parse_json(F.to_json(payload))


def _rendered(facts: DataFrame) -> DataFrame:
    payload = F
    for spider in SPIDERS:
        payload = payload.when(F.col("spider") == spider, F.to_json(PAYLOADS[spider]()))
    return facts.select(F.parse_json(payload).alias("raw_payload"), "spider", "scraped_at_dt")


def rendered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as one raw record of the source its key falls to."""
    return _rendered(order_facts(spark, sf_dir))


def orders_by_folder(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """The rendered orders, those of a landing folder together and folders in order.

    The narrow facts are brought together before payloads are made, so that no payload is
    shuffled or sorted on its way to the zone. Large folders are dealt to several tasks;
    with ``whole`` each lies in one.
    """
    folder, facts = ["spider", "scraped_at_dt"], order_facts(spark, sf_dir)
    facts = facts.repartition(*folder) if whole else facts.hint("rebalance", *folder)
    return _rendered(facts.sortWithinPartitions(*folder))


def raw_orders_as(spark: SparkSession, sf_dir: str, spider: str) -> DataFrame:
    """Every order as a raw record of one source."""
    return order_facts(spark, sf_dir).select(
        _parsed(PAYLOADS[spider]()).alias("raw_payload"),
        F.lit(spider).alias("spider"),
        "scraped_at_dt",
    )
