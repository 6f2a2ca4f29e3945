"""quarry.llm: operators of a training-data pipeline, one module per operator.

Nothing else in the library imports this subpackage. ``registered`` holds the
queries and their SQL for ``__spark_entry__``; ``corpus_pipeline.py`` at the
repository top chains five of the operators.
"""
