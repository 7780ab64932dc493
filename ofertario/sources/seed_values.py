"""The mapping tables results depend on, stated as they are."""

from __future__ import annotations

# Card group -> payment method (one group gives two methods).
BBVA_PAYMENT_METHODS = [
    ("Tarjetas de crédito BBVA", "credit_card", "all", "all"),
    ("Tarjetas de crédito y débito BBVA", "credit_card", "all", "all"),
    ("Tarjetas de crédito y débito BBVA", "debit_card", "all", "all"),
    ("Tarjetas de débito BBVA", "debit_card", "all", "all"),
]

# Fixed values: (card, card type) -> payment method.
GALICIA_PAYMENT_METHODS = [
    ("Tarjeta Access Now Visa", "Credito", "credit_card", "visa", "Access Now"),
    ("Tarjeta PowerCard Visa", "Credito", "credit_card", "visa", "PowerCard"),
    ("Tarjeta Visa", "Credito", "credit_card", "visa", "Standard"),
    ("Tarjeta American Express", "Credito", "credit_card", "amex", "Standard"),
    ("Tarjeta Icon American Express", "Credito", "credit_card", "amex", "Icon"),
    ("Tarjeta Mastercard", "Credito", "credit_card", "mastercard", "Standard"),
    ("Tarjeta PowerCard Mastercard", "Credito", "credit_card", "mastercard", "PowerCard"),
    ("Tarjeta Galicia Débito", "Debito", "debit_card", "visa", "Standard"),
]

# Payment word -> payment method (money on account has no card).
NARANJA_PAYMENT_METHODS = [
    ("credito", "credit_card", "naranja", "Standard"),
    ("debito", "debit_card", "naranja", "Standard"),
    ("dinero", "account_money", None, None),
    ("visa", "credit_card", "visa", "Standard"),
]

# Fixed values: (issuer, raw category) -> published category.
MERCHANT_CATEGORIES = [
    ("Naranja X", "Viajes y turismo", "Viajes y turismo"),
    ("Naranja X", "Supermercados", "Supermercados"),
    ("Naranja X", "Servicios", "Otros"),
    ("Naranja X", "Salud y bienestar", "Salud y belleza"),
    ("Naranja X", "Otros", "Otros"),
    ("Naranja X", "Moda y accesorios", "Moda e indumentaria"),
    ("Naranja X", "Mascotas", "Otros"),
    ("Naranja X", "Librerías", "Otros"),
    ("Naranja X", "Juguetería", "Juguetería y deportes"),
    ("Naranja X", "Hogar y deco", "Hogar y decoración"),
    ("Naranja X", "Gastronomía", "Gastronomía"),
    ("Naranja X", "Entretenimiento", "Entretenimiento"),
    ("Naranja X", "Electro y tecnología", "Electrónica y tecnología"),
    ("Naranja X", "Deportes", "Juguetería y deportes"),
    ("Naranja X", "Construcción", "Vehículos y combustible"),
    ("Naranja X", "Autos y motos", "Vehículos y combustible"),
    ("Naranja X", "Alimentos", "Supermercados"),
    ("Naranja X", "Transportes", "Otros"),
    ("Naranja X", "Educación", "Otros"),
    ("Naranja X", "Combustible", "Vehículos y combustible"),
    ("Banco Galicia", "Viajes", "Viajes y turismo"),
    ("Banco Galicia", "Vehículos", "Vehículos y combustible"),
    ("Banco Galicia", "Transportes", "Otros"),
    ("Banco Galicia", "Supermercados", "Supermercados"),
    ("Banco Galicia", "Salud y Bienestar", "Salud y belleza"),
    ("Banco Galicia", "Peluquerías", "Salud y belleza"),
    ("Banco Galicia", "Otros", "Otros"),
    ("Banco Galicia", "Mascotas", "Otros"),
    ("Banco Galicia", "Librerías", "Otros"),
    ("Banco Galicia", "Juguetes", "Juguetería y deportes"),
    ("Banco Galicia", "Indumentaria", "Moda e indumentaria"),
    ("Banco Galicia", "Hogar", "Hogar y decoración"),
    ("Banco Galicia", "Gastronomía", "Gastronomía"),
    ("Banco Galicia", "Entretenimiento", "Entretenimiento"),
    ("Banco Galicia", "Electrónica", "Electrónica y tecnología"),
    ("Banco Galicia", "Confitería", "Gastronomía"),
    ("Banco Galicia", "Combustible", "Vehículos y combustible"),
    ("Banco Galicia", "Bares", "Gastronomía"),
    ("Banco BBVA", "Viajes", "Viajes y turismo"),
    ("Banco BBVA", "Regalos", "Otros"),
    ("Banco BBVA", "Otros comercios y servicios", "Otros"),
    ("Banco BBVA", "Moda", "Moda e indumentaria"),
    ("Banco BBVA", "Jugueterías", "Juguetería y deportes"),
    ("Banco BBVA", "Hogar y Deco", "Hogar y decoración"),
    ("Banco BBVA", "Gastronomía", "Gastronomía"),
    ("Banco BBVA", "Entretenimiento", "Entretenimiento"),
    ("Banco BBVA", "Electro y Tecnología", "Electrónica y tecnología"),
    ("Banco BBVA", "Deportes", "Juguetería y deportes"),
    ("Banco BBVA", "Belleza", "Salud y belleza"),
    ("Banco BBVA", "Automotores", "Vehículos y combustible"),
]

# Merchants whose category is set by name.
MERCHANT_OVERRIDES = [
    ("Diarco", "Supermercados"),
    ("Supermercados La Reina", "Supermercados"),
    ("Coto", "Supermercados"),
    ("Hiperchangomas", "Supermercados"),
    ("Disco", "Supermercados"),
    ("Supermercados Kilbel", "Supermercados"),
    ("Supermercados La Anonima", "Supermercados"),
    ("Supermercados Dia", "Supermercados"),
    ("Supermercados La Gallega", "Supermercados"),
    ("Supermercados Toledo", "Supermercados"),
    ("Supermercados Vea", "Supermercados"),
    ("Changomas", "Supermercados"),
    ("Supercoop", "Supermercados"),
    ("Supermercados El Tunel", "Supermercados"),
    ("Jumbo", "Supermercados"),
]

# Issuer -> icon file.
ISSUER_ICONS = [
    ("Banco BBVA", "bbva.png"),
    ("Banco Galicia", "galicia.png"),
    ("Naranja X", "naranjax.png"),
]

# Keys every usable payload of a source has.
REQUIRED_KEYS = {
    "galicia": [
        "source_id",
        "tipoPromocion",
        "categoria",
        "marca",
        "fechaDesde",
        "fechaHasta",
        "porcentajeAhorro",
        "descripcionAdicional",
        "legales",
        "topeReintegro",
        "minimoCompra",
        "cuotaSinInteresHasta",
        "diasAplicacion",
        "tiendaOnline",
        "tiendaFisica",
        "leyendaCompra",
        "mediosDePago",
    ],
    "naranjax": [
        "id",
        "commerceName",
        "benefitName",
        "days",
        "benefit",
        "promotionDetails",
        "days.weekdaysApplied",
        "paymentMethods",
    ],
    "bbva": [
        "source_id",
        "cabecera",
        "canalesVenta",
        "beneficios",
        "diasPromo",
        "basesCondiciones",
        "subcabecera",
        "grupoTarjeta",
    ],
}
