"""tablewatch: data-quality metrics, profiles, rules, verification and drift as Spark DataFrame operators."""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Functions of this package that run inside Python tasks (the Arrow passes) are
    pickled by value, so executors need not have the package installed."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:       # an older cloudpickle: ship the package with --py-files instead
        pass


_ship_by_value()
