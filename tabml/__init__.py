"""tabml: tabular feature engineering, model fitting, evaluation and
recommendation operators expressed as Spark DataFrame / Spark ML plans.

Every public function takes DataFrames and returns a DataFrame (or a fitted
Spark ML model).  The heavy lifting is left to Catalyst, whole-stage codegen,
Spark ML's solvers and, for matrix sums and factor scores, numpy in Arrow batches.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, so only the driver
# needs it on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
