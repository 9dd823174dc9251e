"""Website event analytics as Spark DataFrame transformations.

``enrich -> sessionise -> prepare -> metrics -> report``: every step is a pure
``DataFrame -> DataFrame`` function built from Spark's own expressions, so Catalyst sees
one logical plan from the scan to the metric.
"""
