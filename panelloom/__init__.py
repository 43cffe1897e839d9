"""panelloom: harmonize repeated questionnaires into comparable analytics tables on Spark.

Generic operators take DataFrames and column names and know nothing about surveys;
``plans`` puts the survey configuration on top of them.
"""

__version__ = "0.1.0"
