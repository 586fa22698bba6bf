"""papyra: research-paper metadata on Spark, from raw records to lake, state table and reports."""
