"""starsmelt: nested catalogue records to a star schema and parameterised analytics on Spark."""
