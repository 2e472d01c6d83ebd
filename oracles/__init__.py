"""Independent SQL for every registered query, run by another engine on the same tables."""
