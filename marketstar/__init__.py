"""marketstar — equity and macro analytics as Spark DataFrame plans.

Layers:

* ``sources``   — driver-table scans, landed-record adapters, file readers
* ``functions`` — column expressions and the named metric registry
* ``operators`` — reshape, quality and join building blocks
* ``plans``     — star-schema transforms, views, queries, sinks
"""

from .plans.star import Star, build_star, star_from_driver  # noqa: F401
from .plans.queries import Params, QUERIES  # noqa: F401

__all__ = ["Star", "build_star", "star_from_driver", "Params", "QUERIES"]
