"""Training-data operators: token counts, neighbours, BPE, filters, dedup, packing, classifiers.

Nothing else in the library imports this package; it imports only general helpers.
"""
