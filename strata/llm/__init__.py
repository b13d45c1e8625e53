"""Training-data operators: quality, near duplicates, decontamination, mixing, token output and so on.

Nothing else in the package imports this subpackage; its queries are in ``queries``.
"""
