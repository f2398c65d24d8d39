"""Offer recommendation analytics on PySpark.

Scores every (seller, offer) pair of a sales network from its sales history
and ranks the offers per seller.  Every step is a function from DataFrames to
a DataFrame; Spark plans, shuffles and runs the work.
"""
