"""corpusloom: a Spark-native engine for curating, searching and analysing entity corpora.

Sub-packages
------------
operators   relational operators (reconcile, dedupe, profile, drift, nested records, retrieval ...)
functions   scalar Column functions, all JVM-side
sources     readers and writers
plans       the registered queries and their SQL oracles
streaming   Structured Streaming forms of the incremental operators
llm         training-data operators; optional, nothing else imports it
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with them, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
