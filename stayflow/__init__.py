"""stayflow: ICU length-of-stay feature operators on Spark DataFrames."""

__version__ = "0.1.0"
