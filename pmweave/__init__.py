"""Network-counter ETL as Spark DataFrame jobs.

Raw performance-measurement XML goes in, per-cell counter tables come out:

* ``pmweave.sources``    SequenceFiles, directories of plain or gzip XML, counter catalogs
* ``pmweave.functions``  column expressions: file names, periods, object identity, counter arrays
* ``pmweave.operators``  DataFrame -> DataFrame steps: shred, merge, project, sum, check
* ``pmweave.sinks``      delimited reports, summaries and issue logs
* ``pmweave.plans``      the four vendor x technology jobs, end to end
* ``pmweave.streaming``  the same jobs over a landing directory
"""
