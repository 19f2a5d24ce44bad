"""collectra: collections & portfolio analytics as lazy Spark DataFrame transforms.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions; nothing is collected to the driver inside an operator.
"""

__version__ = "0.1.0"
