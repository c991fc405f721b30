"""wardflow: encounter analytics and readmission risk scoring on Spark.

DataFrame -> DataFrame operators plus persistable MLlib stages. Nothing here
collects row-level data to the driver; every fitted statistic is an aggregate.
"""

__version__ = "0.1.0"
