"""Registered queries over the test tables, and the SQL they are checked against."""

from pyspark import cloudpickle

import marquee.functions
import marquee.operators
import marquee.plans
import marquee.sources

# Lets the Python workers run the library's functions wherever the driver was
# started from; a deployment would ship the package with ``--py-files`` instead.
for part in (marquee.functions, marquee.operators, marquee.plans, marquee.sources):
    cloudpickle.register_pickle_by_value(part)
