"""strataq: question curation and large-corpus operators as Spark DataFrame programs."""
