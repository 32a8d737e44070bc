"""tamarind — customer/property warehouse loads expressed as Spark DataFrame plans.

Layout:
  sources/    lake readers (one day, month, year, everything, history, newest row per key)
  functions/  Column -> Column cleaners for dirty operational text (dates, eras, flags, codes)
  operators/  relational helpers (suffixing, lookup joins, unpivot, latest-per-key, defaults)
  sinks/      warehouse loads (replace-by-key upsert, append, schema alignment)
  plans/      the 33 declarative table builders and their specs
  streaming/  daily incremental runs (the studied system has no streaming; see module doc)
  queries/    driver queries: adapters from the test tables, operator and builder checks
"""

__version__ = "0.1.0"
