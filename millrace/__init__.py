"""Corpus preparation and text evaluation as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Arrow helpers travel with the job: executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
