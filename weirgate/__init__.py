"""weirgate: record-intake analytics as DataFrame functions on Spark.

Sub-packages:

* ``functions``  column expressions (text, numbers, time, hashes, URLs, HTML, log events)
* ``sources``    readers and writers (documents, feeds, leads, configuration, model responses, sinks)
* ``operators``  DataFrame -> DataFrame operators (intake, invoices, leads, news, digests, delivery, runs, state, quality)
* ``streaming``  the same work on Structured Streaming
* ``plans``      queries over the given tables, with the SQL that checks them
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
