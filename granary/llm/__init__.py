"""Operators that prepare training text: scoring, deduplication, tokens, shards, packing.

Python workers import this package where they can find it (``PYTHONPATH`` or an installed
package); elsewhere its functions travel to them by value.
"""

import os
import pathlib
import sys

from pyspark import cloudpickle

_ROOT = pathlib.Path(__file__).resolve().parents[2]
if str(_ROOT) not in os.environ.get("PYTHONPATH", "").split(os.pathsep) and _ROOT.name != "site-packages":
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
