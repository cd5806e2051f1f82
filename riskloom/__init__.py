"""riskloom — labelled-transaction analytics as plain Spark DataFrame functions.

Every operator takes and returns a ``pyspark.sql.DataFrame`` (chain them with
``DataFrame.transform``); nothing is computed on the driver except bounded
report rows.  Sub-packages:

* ``sources``   – CSV/parquet scans, table/model/metric sinks, derived fixtures
* ``functions`` – column-expression builders (text cleaning, safe casts, clocks, hashes)
* ``operators`` – DataFrame -> DataFrame operators (cleaning, missing data,
  calendar, behaviour windows, profiling, sampling, modelling, evaluation)
* ``plans``     – the end-to-end batch and the registered query catalogue
* ``streaming`` – notes on running the stateless stages on streaming frames
"""

__version__ = "0.1.0"
