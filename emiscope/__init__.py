"""Carbon-reporting analytics for model catalogues, as Spark DataFrame plans."""

__version__ = "0.1.0"
