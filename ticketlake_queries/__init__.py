"""The registered queries: driver tables in, one operator each, with SQL to check against."""
