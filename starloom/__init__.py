"""starloom: star-schema modelling, table operators and data-quality checks
written on the PySpark DataFrame API."""

__version__ = "0.1.0"
