"""Training-data operators: dedup, personal data, chat, fingerprints,
decontamination, quality, sharding and packing.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its general interface; ``queries.py`` registers one thin query
per operator.
"""
