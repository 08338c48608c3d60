"""Training-data operators: cleaning, deduplication, scoring, packing and encoding of text corpora.

Nothing outside this subpackage imports it.  Operators take DataFrames and return DataFrames;
:mod:`tonnage.llm.queries` binds them to the driver's tables.
"""
