"""Loan-application analytics on Spark DataFrames.

``functions``  Column -> Column expressions
``operators``  DataFrame -> DataFrame building blocks
``sources``    readers and writers with declared schemas
``plans``      end-to-end pipelines: lead extraction, training, scoring
``streaming``  the scoring plan over a stream of JSON requests
``workload``   the registered queries and the SQL each is checked against
"""
