"""tidemart: a layered e-commerce warehouse as PySpark DataFrame operators."""
