"""Sources: delimited text files, CSV period files, database tables for a date window."""
