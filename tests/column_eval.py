"""Evaluate a Column helper on literals through the running session."""

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from nearmiss.functions import course_change


def course_change_value(a: float, b: float) -> float:
    spark = SparkSession.getActiveSession()
    return spark.range(1).select(course_change(F.lit(a), F.lit(b))).first()[0]
