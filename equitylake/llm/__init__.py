"""Operators that prepare training data for language models.

One module per operator; ``registry`` lists the queries. Nothing outside this
folder imports it.
"""
