"""Writers: topics, dimension tables and statistics."""
