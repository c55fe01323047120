"""Training-data operators.  Nothing outside this folder imports it; the queries and their SQL live in ``registry``."""
