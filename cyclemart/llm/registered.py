"""All queries of this subpackage; importing it registers them."""

import corpus_pipeline
from cyclemart.llm import op01, op02, op03, op04, op05, op06, op07, op08, op09, op10, op11, op12, op13  # noqa: F401
from cyclemart.llm.tables import QUERIES, SQL

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
