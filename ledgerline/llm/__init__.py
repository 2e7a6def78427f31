"""Operators for building training text: quality, copies, language, private data,
secrets, urls, benchmark overlap, fingerprints and tokenisation.

Nothing outside this package imports it. Each module holds one operator with a
general interface; ``ledgerline.llm.queries`` derives the registered queries.
"""
