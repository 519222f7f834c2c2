"""Training-data operators: near-duplicate joins, exact deduplication,
tokenising, scans, decontamination and quality rules over document tables.

Nothing else in the package imports this subpackage.
"""
