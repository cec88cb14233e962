"""threadlens: threaded-comment opinion analytics as Spark DataFrame jobs.

Every public operator takes and returns a ``DataFrame``; planning is left to
Catalyst and AQE. Subpackages:

- ``functions``: Column-level expressions (text cleaning, labels, dates).
- ``sources``: driver tables, fixture views, landed CSV/JSON files.
- ``operators``: joins, dedup, thread levels/context, mentions, sentences,
  scoring stages and the entity -> aspect -> sentiment decision chain.
- ``plans``: registered queries and their SQL oracles.
- ``streaming``: Structured Streaming ingest and cleaning.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value into UDF closures, so Python
    workers run them without having the package installed or on their path."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle: ship with --py-files
        pass


_ship_by_value()
