"""Batch landing operators for Spark: plain DataFrame-to-DataFrame functions.

Importing the package has no side effects; every function takes its session, frames and
parameters as arguments.
"""
