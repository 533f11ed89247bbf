"""catchflow: catchment forcing and streamflow evaluation as Spark DataFrame plans."""

__version__ = "0.1.0"
