"""tessera: analytics operators on Spark DataFrames and streams.

* ``tessera.functions`` -- column expressions (Java-compatible text rules,
  tokenizer, labels, time, formats)
* ``tessera.sources`` -- readers and sinks (delimited text, the reference's
  input files, results CSV, TSV, report lines, base64)
* ``tessera.operators`` -- ratings, text, commerce and detection operators,
  plus join / top-k / exact-rank helpers
* ``tessera.streaming`` -- the detection pipeline as streaming queries
* ``tessera.plans`` -- bindings to the test tables, registered queries and
  their oracle SQL
"""

__version__ = "0.1.0"
