"""Card-transaction risk analytics expressed as lazy Spark DataFrame plans."""
