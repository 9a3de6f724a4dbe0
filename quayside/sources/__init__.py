"""Scans: files, folders, documents, workbooks and partitioned tables as DataFrames."""
