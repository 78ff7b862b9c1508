"""logloom: typed tables from raw blockchain logs and call traces, on Spark.

Jobs: ABI catalog and signature registry, token-standard classification,
ERC-20/721/1155 event tables, registry-driven decoding of any event or call,
and a price dimension. See README.md for the operator inventory.
"""

import sys

from pyspark import cloudpickle as _cloudpickle

# The few Python-side pieces (Arrow UDFs, the Keccak mapInPandas) are shipped
# with the task by value, so executors need no installed copy of this package.
_cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
