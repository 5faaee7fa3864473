"""Where raw records come from and where tables are kept."""
