"""lectern: a PySpark-native engine for corpora of people profiles.

Sub-packages
------------
functions   column expressions (text, URLs, hashes, names)
operators   DataFrame -> DataFrame relational operators
sources     readers, writers and table stores
streaming   Structured Streaming operators
plans       the named queries and their SQL counterparts
llm         operators for training-data pipelines (optional, nothing imports it)
"""

__version__ = "0.1.0"
