"""Document-evidence analytics as composable Spark DataFrame operators.

Pages become sections, sections become sentence chunks and vectors, the best
chunk per (country, question) becomes evidence, evidence becomes scored
predictions, and predictions become reports.  Every operator takes and returns
DataFrames (or Columns), so Catalyst sees one declarative plan end to end.
"""

import sys

from pyspark import cloudpickle

# The few Python functions that run inside tasks travel with the job itself, so
# executors need no copy of this package on their import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
