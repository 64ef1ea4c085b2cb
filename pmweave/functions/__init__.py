"""Column expressions. None of them needs a Python UDF."""
