"""The ingestion run and the state it keeps."""
