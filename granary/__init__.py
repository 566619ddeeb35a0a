"""Inventory and order analytics as lazy PySpark DataFrame plans.

Layers, from the bottom up:

* ``functions``  Column -> Column helpers (text, dates, numbers, sample moments)
* ``sources``    scans, payload flatteners and sinks
* ``operators``  DataFrame -> DataFrame building blocks
* ``plans``      the published data products
* ``streaming``  incremental refresh of landed files
"""

from granary.session import configure, local_session

__all__ = ["configure", "local_session"]
