"""Reading raw files, writing tables, and their schemas."""
