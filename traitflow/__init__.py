"""traitflow: quantitative-trait extraction from clinical extracts, written as Spark jobs.

Layout:
  functions/  Column -> Column helpers (parsing, units, ranges, region predicates)
  operators/  DataFrame -> DataFrame steps (filters, dedup, intervals, regions, traits,
              people, tiles, stats, audit)
  sources/    readers, raw-line hygiene, per-source ingest recipes, sinks
  plans/      the end-to-end pipeline, driver-table bindings and the query catalog
  llm/        operators for preparing language-model training data (optional subpackage)
"""

__version__ = "0.1.0"
