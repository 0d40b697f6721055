"""Permission-aware document analytics as composable Spark DataFrame operators.

``functions``  Column expressions (text, rules, access control, vectors)
``operators``  DataFrame -> DataFrame building blocks (joins, top-k, metrics)
``sources``    readers and writers with declared schemas
``plans``      end-to-end jobs assembled from the operators
``streaming``  incremental versions of the batch jobs
``catalog``    the registered queries and their SQL counterparts
"""
