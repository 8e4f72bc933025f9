"""foldgauge: multi-label text evaluation as lazy Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

from foldgauge.schema import CorpusSchema

# Functions sent to executors travel with their code, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["CorpusSchema"]
