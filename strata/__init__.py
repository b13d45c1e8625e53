"""strata: medallion-style analytics (bronze -> silver -> derived) on PySpark.

Every operator is a DataFrame -> DataFrame function that Catalyst plans;
versioned tables are change logs (see ``strata.sources.changelog``).
"""

__all__ = ["session"]
