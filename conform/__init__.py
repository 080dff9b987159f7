"""Raw operational extracts to a star schema, as Spark DataFrame plans."""
