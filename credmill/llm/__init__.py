"""Operators that prepare text for the training of language models.

One module for each operator, its query beside it; ``registry`` lists the queries.
Nothing outside this package imports it.
"""
