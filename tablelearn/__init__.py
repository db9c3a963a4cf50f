"""tablelearn: learning from tables on Spark.

Readers and writers (``sources``), table shaping, splits, features, metrics
and series operators (``operators``), column expressions (``functions``),
Spark ML model plans and the data-parallel sequence model (``plans``).
Every operator takes and returns DataFrames.
"""

__version__ = "0.1.0"


def _ship_with_closures() -> None:
    """Pickle this package's functions by value inside Spark closures, so Python
    workers (``mapInPandas`` / ``applyInPandas``) do not need ``tablelearn`` on
    their own path. ``--py-files`` works too; this only removes the need for it."""
    import sys

    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except (ImportError, AttributeError, ValueError):
        pass


_ship_with_closures()
