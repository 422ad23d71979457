"""Text search, link ranking and throughput measurement as Spark jobs.

Every public function takes and returns DataFrames; paths, terms, list sizes,
iteration counts and targets are parameters. The main entry points:

* ``plans.search``      TF-IDF over a corpus, and the best documents of a term
* ``plans.pagerank``    PageRank over arcs, and the best nodes with their titles
* ``plans.throughput``  requests per second from test logs, against a target
* ``streaming``         the same throughput totals as a continuing query
"""
