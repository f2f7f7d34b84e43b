"""logforge: telemetry shaping (logs and metrics) as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

from logforge.session import configure, work_dir

# Ship the small Python helpers inside the tasks, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["configure", "work_dir"]
