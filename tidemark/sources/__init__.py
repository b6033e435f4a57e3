"""Files and tables in and out."""
