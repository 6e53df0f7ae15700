"""Operators for preparing language-model training data. Nothing else in the library imports this package.

Each module is one operator with a general interface; ``queries`` applies them to the test tables. Operators read
the columns they are given by name and return their own columns only, so that further columns of the input, whatever
they are called, never clash with internal names.
"""
