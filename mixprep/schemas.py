"""Declared schemas (no inference pass on read)."""

from pyspark.sql.types import ArrayType, StringType, StructField, StructType

SFT = StructType([StructField("system", StringType()), StructField("prompt", StringType()),
                  StructField("response", StringType())])
ALPACA = StructType([StructField("instruction", StringType()), StructField("input", StringType()),
                     StructField("output", StringType()),
                     StructField("history", ArrayType(ArrayType(StringType())))])
