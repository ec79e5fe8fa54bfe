"""tidewell: curation of observation tables and text corpora as Spark jobs."""
