"""Training-data operators: ten document and conversation operators on Spark.

Nothing outside this package imports it; ``queries.py`` holds the registered queries.
"""
