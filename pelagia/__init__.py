"""Environmental opportunity analytics as PySpark DataFrame transformations."""
