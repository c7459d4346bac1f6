"""Writers: tables, staging rows, messages, bulk files."""
