"""Panel time-series feature engineering and forecasting on Spark.

Every operator takes and returns a lazy ``DataFrame``.  Three frame layouts are
used throughout:

* *readings*  - raw rows, any granularity, any number per hour;
* *panel*     - one row per ``(keys..., date, hour)``;
* *profile*   - one row per ``(keys..., date)`` holding the day's 24 values in
  an ``array<double>``.  Lags, trailing statistics and horizons are computed on
  profiles, because that shuffles and sorts 24 times fewer rows than a panel.
"""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel whole, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
