"""Evidence-preserving extraction and cleaning of tables on Spark.

``functions``  Column -> Column expressions (text, extraction, classification, values)
``operators``  DataFrame -> DataFrame operators (deduplication, joins, outliers, ids, gates, profiles)
``sources``    readers and writers (delimited text, page tables, post archives, site maps, snapshots)
``plans``      the user-facing compositions (collect, clean, review, summarise)
``rules``      the keyword, pattern, template and stopword data the operators are driven by
"""
