"""Operators of a training-data pipeline: search, packing, extraction, scoring, deduplication, mixing.

Python workers import this package like any other.  Where they could not find it (run from a checkout,
neither installed nor on PYTHONPATH nor in the working folder), its functions travel with the tasks.
"""

import os
from pathlib import Path

from pyspark import cloudpickle

import lakemart

_home = Path(lakemart.__file__).resolve().parents[1]
_seen = [Path.cwd(), *(Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p)]
if _home not in _seen and "site-packages" not in _home.parts:
    cloudpickle.register_pickle_by_value(lakemart)
