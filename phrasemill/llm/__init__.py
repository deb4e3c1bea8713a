"""Training-data operators: one module per operator, queries in :mod:`phrasemill.llm.queries`.

Nothing outside this package imports it.
"""
