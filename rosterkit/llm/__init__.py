"""Operators that prepare training data on Spark, for inputs of any size.

Nothing else in the library imports this subpackage. Each module holds
one operator with its own interface; ``queries`` registers one thin
``opN_<name>`` query per operator.
"""
