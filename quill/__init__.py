"""quill — business reporting operators and reports as Spark jobs.

Layout: ``sources`` (tables in, tables out), ``functions`` (Column
expressions), ``operators`` (joins, aggregates, keys, audits, updates),
``plans`` (the reports) and ``streaming`` (nothing: see its docstring).
"""

__version__ = "0.1.0"
