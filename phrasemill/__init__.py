"""Phrasemill: search-phrase consolidation as Spark DataFrame plans."""
