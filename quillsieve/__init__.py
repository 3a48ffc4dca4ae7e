"""quillsieve: document curation and article analytics expressed as Spark DataFrames."""
