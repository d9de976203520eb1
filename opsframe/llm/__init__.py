"""Operators for preparing language-model training data, on Spark.

One module per operator; ``queries`` registers one query for each. Nothing outside this folder,
``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
