"""bitloom: bilingual-corpus curation and terminology analytics on Spark."""
