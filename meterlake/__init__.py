"""meterlake: meter-reading analytics on Spark DataFrames.

Cleaning, profiling, feature derivation, fitted transformers, model fitting,
scoring and evaluation, expressed as Spark DataFrame / SQL / MLlib /
Structured Streaming plans.
"""

__version__ = "0.1.0"
