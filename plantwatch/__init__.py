"""plantwatch: sensor-fleet health, failure labels and failure prediction as Spark jobs.

Every operator is a plain ``DataFrame -> DataFrame`` function. Nothing in the package
collects a table: the only values that reach the driver are one-row aggregates and
learned model parameters, whose number depends on the columns and never on the rows.
"""

__version__ = "0.1.0"
