"""Training-data operators over the ``documents`` table.

Nothing outside this subpackage imports it.  ``registry`` maps query names to
callables; every other module holds one operator with a general interface and
the thin contract query derived from it.
"""
