"""Training-data operators: one module an operator, `queries` registers them.

Nothing else in the library imports this subpackage.
"""
