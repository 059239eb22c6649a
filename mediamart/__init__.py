"""mediamart: typed ingest of delimited sources into a partitioned Parquet
lake, narrowed serving tables with pre-aggregates and views, and star-schema
queries over them - all as Spark DataFrame / SQL jobs.

Layout:
  specs.py     declarative dataset specs (raw schema, cleaning rules, layout)
  functions/   Column -> Column builders (casts, fills, splits, buckets)
  sources/     TSV reader (plain / gzip, sentinel NULLs, header check)
  sinks/       Parquet lake writer/reader, serving tables
  operators/   cleaners, joins, rollup, data-quality checks
  plans/       marts (the benchmark questions and views), analog inputs,
               the query catalog with its DuckDB oracles
  jobs.py      etl() and load(): the two batch jobs
"""
