"""ticklake: market-data analytics on Spark (see README.md)."""

import sys as _sys

# The few functions that run inside Python workers (the vectorised fixture
# encoders under mapInArrow, the T2 state function) are shipped *by value*,
# so executors need not have this package installed or on their path.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: fall back to --py-files
    pass
