"""quarry: Spark-native preparation of labelled text corpora.

Every public operator takes and returns DataFrames. Most stay lazy; global
indexes, per-group numbers, reply-tree propagation and the cleaning jobs run
jobs when called, because they fix narrow tables in the checkpoint folder. The
package layout is

- ``quarry.sources``   readers for the raw corpus layouts (delimited, JSON, trees)
- ``quarry.sinks``     writers and output layouts (delimited, folds, STS/SST/pairs)
- ``quarry.functions`` column expressions (text, web, math) used by operators
- ``quarry.operators`` DataFrame -> DataFrame jobs (labels, joins, threads,
                       indexing/splits, aggregates/metrics, text jobs, quality)
- ``quarry.plans``     fixture views over the shared tables and end-to-end pipelines
- ``quarry.llm``       operators of a training-data pipeline (optional)
"""

__version__ = "0.1.0"
