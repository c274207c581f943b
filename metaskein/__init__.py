"""metaskein: metadata-catalog snapshots, profiling and deltas as Spark jobs.

Modules:

* ``functions``  column helpers (text, identity, formatting), built-ins only
* ``sources``    catalog tables, catalog JSON documents, snapshot storage, sinks
* ``operators``  upsert, diff, cascade, flattening, profiling, document merge
* ``plans``      the two end-to-end flows built from the operators
"""
