"""Complete payloads of each source; tests change single fields."""

from __future__ import annotations

import copy

BBVA = {
    "source_id": 7,
    "cabecera": "Starbucks 20% de descuento",
    "subcabecera": "Todos los dias",
    "basesCondiciones": "Bases.",
    "category_name": "Gastronomía",
    "discount_start_date": "2025-01-01",
    "discount_end_date": "2025-12-31",
    "beneficios": [{"tope": "1000", "cuota": "6", "requisitos": ["Nada"]}],
    "diasPromo": "1,0,1,0,1,0,0",
    "canalesVenta": {"web": ["x"], "sucursales": []},
    "esModo": False,
    "grupoTarjeta": "Tarjetas de crédito BBVA",
}
GALICIA = {
    "source_id": "g1",
    "tipoPromocion": "Marca",
    "categoria": {"descripcion": "Bares"},
    "marca": {"nombre": "Coto", "categoria": {"descripcion": "Supermercados"}},
    "fechaDesde": "01/02/2025",
    "fechaHasta": "2/6/2025",
    "porcentajeAhorro": "20",
    "descripcionAdicional": "Algo",
    "legales": "Legal",
    "topeReintegro": "5000",
    "minimoCompra": " ",
    "cuotaSinInteresHasta": None,
    "diasAplicacion": "Lu;Mi;Vi",
    "tiendaOnline": True,
    "tiendaFisica": False,
    "leyendaCompra": "Nada",
    "mediosDePago": [{"tarjeta": "Tarjeta Visa", "tipoTarjeta": "Credito"}],
}
NARANJAX = {
    "id": "n1",
    "commerceName": "Farmacity",
    "category": {"name": "Salud y bienestar"},
    "benefitName": "6 cuotas cero interés",
    "subtitle": "Sub",
    "legal": "Legal",
    "discount_url": "https://x/y",
    "days": {"dateFrom": "01/01/2025", "dateTo": "31/12/2025", "weekdaysApplied": [1, 3, 5]},
    "benefit": {"discountPercentage": 15},
    "promotionDetails": {
        "refundLimit": "",
        "forPurchasesOver": 100,
        "appliesOnline": False,
        "appliesInStore": True,
    },
    "commerces": [],
    "paymentMethods": ["credito", "dinero"],
}


def changed(payload: dict, **fields) -> dict:
    """A copy with fields replaced; ``a__b`` reaches into objects, ... drops."""
    result = copy.deepcopy(payload)
    for path, value in fields.items():
        *parents, last = path.split("__")
        node = result
        for parent in parents:
            node = node[parent]
        if value is ...:
            node.pop(last)
        else:
            node[last] = value
    return result
