"""What the driver contract registers: the operators and the corpus pipeline."""

import corpus_pipeline
from marquee.llm import bindings

QUERIES = {**bindings.QUERIES, "pipeline": corpus_pipeline.run}
SQL = {k: v for k, v in {**bindings.SQL, "pipeline": corpus_pipeline.ORACLE_SQL}.items() if v}
