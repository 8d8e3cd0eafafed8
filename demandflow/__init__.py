"""demandflow: spatio-temporal demand analytics as Spark DataFrame plans.

Every public function maps DataFrame -> DataFrame (or returns a Column
expression) and leaves physical planning to Catalyst/AQE.
"""

__version__ = "0.1.0"
