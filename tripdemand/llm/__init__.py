"""Training-data operators: text cleaning, search, joins, tokens and embeddings on Spark.

One module per operator; ``queries`` registers a query for each. Nothing outside this
subpackage imports it.
"""
