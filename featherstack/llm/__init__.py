"""Training-data operators: near-duplicates, language, quality, toxicity,
decontamination, line and passage dedup, URL filters and byte-level BPE.

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered ``opN_*`` queries and their SQL.
"""
