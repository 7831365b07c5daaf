"""The library's operators run on the shared star-schema tables, with the SQL to check them."""
