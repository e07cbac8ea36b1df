"""cinderspan: geospatial event analytics and evaluation tables as PySpark jobs."""

__version__ = "0.1.0"
