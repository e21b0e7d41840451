"""strata: a Spark-first medallion (bronze / silver / gold) batch engine.

Transforms are pure DataFrame -> DataFrame functions; only the table
store, the bronze extractors and the pipeline runner perform IO.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
