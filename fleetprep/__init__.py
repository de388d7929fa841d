"""Preparation, profiling and supervised modelling of one large wide table, as plain PySpark DataFrame functions."""
