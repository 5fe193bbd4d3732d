"""Column expressions, rule tables and the one Arrow UDF."""
