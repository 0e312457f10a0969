"""starloom: a Spark-native toolkit for building and querying a snowflake-schema
warehouse (conform overlapping record sets, build dimensions and facts with
stable surrogate keys, check keys as distributed jobs, answer the analytical
reports, and mine association rules with multi-item consequents).

Everything is expressed with the DataFrame / SQL API; no function here collects
data to the driver beyond bounded, size-checked metadata.
"""

__all__ = ["session"]
