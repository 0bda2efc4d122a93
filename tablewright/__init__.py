"""Distributed data-preparation operators for PySpark.

Every operator is a plain function over DataFrames and Columns.  The session is
always the caller's; nothing here starts or stops one.

* ``tablewright.functions``  Column -> Column helpers
* ``tablewright.operators``  DataFrame -> DataFrame operators
* ``tablewright.sources``    readers, writers and scratch storage
* ``tablewright.plans``      whole batch jobs
* ``tablewright.catalogue``  the registered queries and their SQL twins
"""
