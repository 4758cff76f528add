"""Rule-based extraction of differently shaped register records into one nested product document."""
