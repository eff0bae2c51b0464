"""tallyspark: a Spark-native engine that turns folders of bank-statement
exports into one de-duplicated transaction ledger.

Sub-packages
------------
functions   Column -> Column building blocks (cleaning, identity, similarity)
sources     scans and sinks (statement grids, ledger, accounts, HTML tables)
operators   relational operators (identification, layouts, merge, metrics)
plans       end-to-end batch jobs and the query registry
streaming   drop-folder ingest with Structured Streaming
"""

__all__ = ["session", "schema"]


def _ship_by_value() -> None:
    """UDFs and grouped-map functions of this package are pickled by value,
    so executors run them without the package being installed there."""
    import sys

    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle
        pass


_ship_by_value()
