"""Training-data operators: extraction, classification, formatting, encoding, packing and near-duplicate detection.

Nothing outside this subpackage imports it; it can be removed as a whole.
"""
