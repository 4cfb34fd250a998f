"""Raw files in and out, and the table contracts."""
