"""What a table is and what scanning it means."""
