"""DataFrame -> DataFrame operators over the wide encounter table."""
