"""Reading source files and tables, writing result files."""
