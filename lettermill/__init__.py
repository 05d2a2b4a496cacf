"""lettermill: incremental mail-file ingestion as Spark jobs.

Buckets of mail files go in; emails, lineage, skips, manifests and a source
ledger come out, deduplicated per tenant and published one run at a time.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Task code travels with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
