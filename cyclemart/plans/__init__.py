"""The warehouse: staging to fact, marts, quality gate, analysis and reports."""
