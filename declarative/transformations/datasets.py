"""Datasets of the declarative run; settings come from ``spark-pipeline.yml``."""

from pyspark.sql import SparkSession

from opinio.plans.declarative import define
from opinio.plans.layered import Layers

session = SparkSession.active()
define(
    session,
    session.conf.get("opinio.landing"),
    Layers(prefix=session.conf.get("opinio.prefix")),
)
