"""Reading tables and documents, writing snapshots."""
