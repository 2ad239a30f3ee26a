"""A PySpark analytics engine for catalogue-style entity data."""
