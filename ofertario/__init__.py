"""ofertario: promotion and offer catalogues as Spark DataFrame operators."""
