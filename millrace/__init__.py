"""Stream-or-batch analytics building blocks on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

from millrace.session import build_session, run_folder

# Code of this package that runs inside tasks (row writers) travels with the task,
# so executors do not need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "run_folder"]
