"""callframe: tool-calling data jobs on Spark DataFrames.

Every job is a function ``DataFrame -> DataFrame`` built from native
Column expressions; actions happen only in ``callframe.plans`` and in
the streaming runners.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Python workers need not have this package installed: functions of the
# package (the few Arrow UDFs) are shipped by value with the job.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from callframe.session import configure, get_session  # noqa: E402

__all__ = ["configure", "get_session"]
