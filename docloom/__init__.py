"""docloom: document-table analytics expressed as Spark DataFrame jobs."""
