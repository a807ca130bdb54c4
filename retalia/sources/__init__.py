"""Where data comes from and where intermediate tables are kept."""
