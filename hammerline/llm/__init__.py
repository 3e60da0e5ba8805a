"""Training-data operators: filters, classifiers, de-duplication, packing and search.

Each module holds one operator with its own general interface; ``registry``
turns them into the named queries.  Nothing outside this subpackage imports it.
"""
