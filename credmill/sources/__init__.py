"""Reading and writing: files, external tables, the derived loan view."""
