"""smogline: air-quality analytics expressed as Spark DataFrame plans.

Every operator is a function ``DataFrame -> DataFrame`` (plus parameters).
Nothing is collected to the driver; Catalyst plans and runs the work.
"""

__version__ = "0.1.0"
