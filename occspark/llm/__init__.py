"""Training-data operators: quality, licences, extraction, near-duplicates, packing, scoring, search.

Nothing outside this subpackage imports it; its queries are in ``llm.queries``.
"""
