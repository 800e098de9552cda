"""Social-post analytics as lazy PySpark DataFrame operators."""
