"""Text-corpus analytics as Spark DataFrame operators.

``sources``    scans of text folders, sinks, and scratch space
``functions``  column expressions for tokens, headers, dates and clean-up
``operators``  DataFrame-in, DataFrame-out operators
``plans``      input views, registered queries and their oracle SQL
"""
