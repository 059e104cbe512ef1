"""Corpus operators of a training-data pipeline; ``recurra.llm.queries`` registers them."""
