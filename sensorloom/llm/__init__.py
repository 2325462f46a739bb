"""Operators for training-data pipelines over documents and web pages.

Nothing else in the package imports this folder. Functions that run in Python workers travel with the
job (pickled by value), so executors need the third-party packages but no copy of this folder.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
