"""SQL expressions: text, dates, scoring ladders, column lists.

The functions here take and give SQL text for ``selectExpr``, ``where`` and
``expr``.  A whole table of rules then reaches the JVM in one call.
"""
