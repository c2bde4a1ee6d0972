"""siltworks: curation of code and text corpora as lazy Spark plans."""
