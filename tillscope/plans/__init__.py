"""The reports and the SQL views."""
