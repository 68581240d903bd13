"""The operators bound to the supplied test tables, each next to its SQL counterpart.

Used by the entry file, the bench and the tests only.
"""
