"""Reading text feeds, writing and reading prepared tables and models."""
