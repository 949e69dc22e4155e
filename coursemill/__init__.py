"""Spark-native processing for online-learning data.

Layers: ``sources`` read, ``functions`` are column expressions, ``operators``
are frame-to-frame steps, ``streaming`` runs the same steps on streams and
``plans`` strings them together into warehouse jobs.
"""
