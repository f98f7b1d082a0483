"""Retail recommendation analytics as PySpark DataFrame operators.

``functions``  column expressions (keys, dates, decay weights, list handling)
``sources``    schemas, readers and writers
``operators``  DataFrame in, DataFrame out building blocks
``plans``      the recommenders, composed from the operators
"""
