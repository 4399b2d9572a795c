"""Training-data operators: near-dedup, mixing, classifiers, token files, fingerprints, extraction, decontamination.

Nothing else in the library imports this subpackage.
"""
