"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; delete the folder and the table-sync operators still work.
"""
