"""tastemine: preference mining and recommendations as Spark DataFrame / ML jobs.

Subpackages
-----------
sources    test-table adapter and file sources / sinks
functions  column-expression helpers (genre parsing, text, fuzzy ratio)
operators  one module per operator family, ``DataFrame -> DataFrame``
plans      composed stage graphs and the registered query catalogue
streaming  incremental ingestion of new interaction files
"""

__version__ = "0.1.0"
