"""tessera: warehouse-modelling operators on Spark DataFrames.

Every operator is a plain function ``DataFrame(s) + column names + parameters
-> DataFrame`` built from native Spark expressions, joins and windows, so the
work is planned by Catalyst and runs on the executors.

Sub-packages:

* ``sources``   -- table loaders, type normalisation, writers (upsert, partition overwrite)
* ``functions`` -- column-expression helpers (classes, flags, masks, JSON properties)
* ``operators`` -- cumulative dimensions, SCDs, graph, facts, activity, quality checks
* ``plans``     -- stand-in bindings of the test tables and the registered queries
* ``streaming`` -- streaming and micro-batch dedupe
"""

__version__ = "0.1.0"
