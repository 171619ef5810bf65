"""Operators for preparing training text at scale. Nothing else in the library imports them."""

import os

import riskloom


def _reach_workers() -> None:
    """Tasks import this package. Where they could not, Spark sends its functions along instead."""
    from pyspark import cloudpickle

    root = os.path.dirname(os.path.dirname(os.path.abspath(riskloom.__file__)))
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if root not in [os.path.abspath(p) for p in known if p]:
        cloudpickle.register_pickle_by_value(riskloom)


_reach_workers()
