"""Driver queries: operator checks on the test tables, and the 33 table builders run
over *adapters* — ANSI SELECTs that project a test table into a source table's shape
(text dates, Y/N flags, blanks, Buddhist years).  The same adapter text feeds Spark
and the DuckDB oracle; the builders are DataFrame code, the oracles independent SQL."""
