"""The regional tables and the reports on them."""
