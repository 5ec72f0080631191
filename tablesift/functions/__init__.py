"""Part of tablesift; see README.md."""
