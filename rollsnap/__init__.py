"""rollsnap: a Spark-native engine for periodic registry snapshots.

Operators are plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
functions built on Spark SQL built-ins, so Catalyst sees one declarative plan
per feed and can push filters, prune columns and pick join strategies.

Sub-packages:

* ``functions``  scalar column functions (strip, dates, marks, link keys, tokens)
* ``operators``  projections, filters, de-duplication, diffs, reshaping,
                 address resolution (token joins), dimension lookups, metrics
* ``sources``    delimited / zipped / table scans and the sinks
* ``plans``      feed compositions and bindings to the driver tables
* ``streaming``  file-source streams with idempotent append
"""

__version__ = "0.1.0"
